"""Letters of Latin, Indic, Cyrillic and Greek scripts to ASCII, as translate and replace expressions that stay in the JVM.

Latin letters follow a rule, their canonical decomposition; letters without one, and Devanagari letters, are listed.
Devanagari: consonants carry no vowel of their own, long and short vowels are one, retroflex and dental are one, virama
and nukta vanish, nasal signs give m. The other Indic scripts have the same letters at the same places of their blocks, so
they become Devanagari first. Cyrillic and Greek letters are listed, lower case only, as case is given up by all that clean
texts. Other scripts are left alone, so that cleaning turns them into spaces.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _latin() -> dict[str, str]:
    out = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii():
            out[chr(code)] = base
    return out


LATIN = _latin() | {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "ı": "i", "ħ": "h", "Ħ": "H"}
LATIN_PAIRS = {"ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "TH"}
DEVANAGARI = dict(zip("कगचजटतडदपबमयरलवशषसहनणङञळअआाइईिीउऊुूएेओोऋृ०१२३४५६७८९।ंँ", "kgcjttddpbmyrlvssshnnnnlaaaiiiiuuuueeoorr0123456789.mm", strict=True))
DEVANAGARI_PAIRS = {"ख": "kh", "घ": "gh", "छ": "ch", "झ": "jh", "ठ": "th", "थ": "th", "ढ": "dh", "ध": "dh", "फ": "ph", "भ": "bh", "ऐ": "ai", "ै": "ai", "औ": "au", "ौ": "au", "ः": "h"}
DEVANAGARI_SILENT = "़्"


#: Bengali, Gurmukhi, Gujarati, Oriya, Tamil, Telugu, Kannada, Malayalam.
INDIC_BLOCKS = range(0x980, 0xD80, 0x80)
CYRILLIC = dict(zip("абвгдезийклмнопрстуфыэёіїєґў", "abvgdeziyklmnoprstufyeeiiegu", strict=True))
CYRILLIC_PAIRS = {"ж": "zh", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ю": "yu", "я": "ya"}
CYRILLIC_SILENT = "ъь"
GREEK = dict(zip("αάβγδεέζηήιίϊΐκλμνξοόπρσςτυύϋΰφωώ", "aavgdeeziiiiiiklmnxooprsstyyyyfoo", strict=True))
GREEK_PAIRS = {"θ": "th", "χ": "ch", "ψ": "ps"}


def latin_letters() -> str:
    """Letters with a Latin name as ranges of a character class."""
    blocks = (range(0x41, 0x250), range(0x250, 0x2C0), range(0x1D00, 0x1F00), range(0x2071, 0x2190), range(0x2C60, 0x2C80), range(0xA720, 0xA800), range(0xAB30, 0xAB70), range(0xFB00, 0xFB07), range(0xFF21, 0xFF5B))
    codes = [c for block in blocks for c in block if chr(c).isalpha() and unicodedata.name(chr(c), "").startswith("LATIN")]
    ends = [c for c, after in zip(codes, [*codes[1:], 0], strict=True) if after != c + 1]
    starts = [c for before, c in zip([0, *codes[:-1]], codes, strict=True) if c != before + 1]
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends, strict=True))


def _replaced(text: Column, pairs: dict[str, str], single: dict[str, str], silent: str = "") -> Column:
    for letter, letters in pairs.items():
        text = F.replace(text, F.lit(letter), F.lit(letters))
    return F.translate(text, "".join(single) + silent, "".join(single.values()))


def transliterate(text: Column) -> Column:
    """Each chain of replacements is met only by texts that hold letters of its scripts."""
    latin = _replaced(text, LATIN_PAIRS, LATIN)
    places = [(chr(b + i), chr(0x900 + i)) for b in INDIC_BLOCKS for i in range(0x80)]
    indic = F.translate(latin, "".join(p[0] for p in places), "".join(p[1] for p in places))
    indic = F.when(text.rlike(r"[\x{900}-\x{D7F}]"), _replaced(indic, DEVANAGARI_PAIRS, DEVANAGARI, DEVANAGARI_SILENT)).otherwise(latin)
    east = _replaced(_replaced(F.lower(indic), CYRILLIC_PAIRS, CYRILLIC, CYRILLIC_SILENT), GREEK_PAIRS, GREEK)
    return F.when(~text.rlike(r"[^\x00-\x7F]"), text).when(text.rlike(r"[\x{370}-\x{52F}]"), east).otherwise(indic)
