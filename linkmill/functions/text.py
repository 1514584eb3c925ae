"""Normal forms of business names and addresses, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkmill.functions import vocab
from linkmill.functions.translit import latin_letters, transliterate

_ENDING = r"\.(?:" + "|".join(vocab.DOMAIN_ENDINGS) + r")\b"
URL_PARTS = r"(?i)https?://|www\.|" + _ENDING
HAS_URL = r"(?i)https?://|www\.|[a-z0-9]" + _ENDING
OTHER_LETTER = rf"[\p{{L}}&&[^{latin_letters()}]]"
STOP_PHRASES = r"\b(?:" + "|".join(vocab.NAME_STOP_PHRASES) + r")\b"


def _text(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def basic_clean(c: Column) -> Column:
    """ASCII, lower case, `&` as a word, and single spaces for all else."""
    return F.trim(F.regexp_replace(F.replace(F.lower(transliterate(c)), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def tokens(c: Column) -> Column:
    """Words between spaces; none of an empty text."""
    return F.filter(F.split(c, " "), lambda t: t != "")


def without_zeros(c: Column) -> Column:
    """A run of digits without leading zeros; zeros alone are one zero."""
    return F.regexp_replace(c, "^0+(?=.)", "")


def words_map(d: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in d.items() for x in pair)) if d else F.lit(None).cast("map<string,string>")


def name_norm(raw) -> Column:
    return basic_clean(F.regexp_replace(F.substring_index(_text(raw), "|", 1), URL_PARTS, " "))


def name_words(norm: Column) -> Column:
    """Words without legal forms, fillers and honorifics."""
    stop = F.array(*(F.lit(w) for w in vocab.NAME_STOP))
    return F.filter(tokens(F.regexp_replace(norm, STOP_PHRASES, " ")), lambda t: ~F.array_contains(stop, t))


def name_core(norm: Column, words: Column) -> Column:
    """The words without adjacent repeats; the whole name if nothing is left. `words` should be a column of its own, as each
    word looks at the one before it."""
    core = F.array_join(F.filter(words, lambda t, i: (i == 0) | (t != F.coalesce(F.get(words, i - 1), F.lit("")))), " ")
    return F.when(core == "", norm).otherwise(core)


def has_url(raw) -> Column:
    return _text(raw).rlike(HAS_URL).cast("byte")


def nonlatin(raw) -> Column:
    """Whether a letter's name in the character tables is not that of a Latin letter."""
    return (_text(raw).rlike(r"[^\x00-\x7F]") & _text(raw).rlike(OTHER_LETTER)).cast("byte")


def address_parts(raw) -> Column:
    """Cleaned, non-empty parts between commas: the text is cleaned as a whole, but for commas, and then split."""
    text = F.regexp_replace(F.replace(F.lower(transliterate(_text(raw))), F.lit("&"), F.lit(" and ")), "[^a-z0-9,]+", " ")
    return F.array_remove(F.transform(F.split(text, ","), lambda p: F.trim(p)), "")


def tail_parts(raw, n: int = 2) -> Column:
    """The last n of them."""
    parts = address_parts(raw)
    return F.when(F.size(parts) <= n, parts).otherwise(F.slice(parts, -n, n))


def is_number(t: Column) -> Column:
    return t.rlike("^[0-9]+$")


def address_token(t: Column) -> Column:
    t = F.when(is_number(t), without_zeros(t)).otherwise(t)
    return F.coalesce(F.try_element_at(words_map(vocab.ADDRESS_WORDS), t), t)


def address_words(parts: Column) -> Column:
    """The words of each part; parts are clean, so that single spaces stand between words."""
    return F.transform(parts, lambda p: F.split(p, " "))


def address_admin(words: Column, aliases: dict[str, str]) -> Column:
    """For each part, the region that it names, or null. Regions are looked up on the last two parts, as whole parts without
    their numbers; parts of the word `null` count as parts."""
    if not aliases:
        return F.transform(words, lambda w: F.lit(None).cast("string"))
    table = words_map(aliases)
    name = lambda w: F.array_join(F.filter(w, lambda t: ~is_number(t)), " ")
    return F.transform(words, lambda w, i: F.when(i >= F.size(words) - 2, F.try_element_at(table, name(w))))


def address_tokens(words: Column) -> Column:
    """The words of each part in normal form, without the word `null`."""
    return F.transform(words, lambda w: F.transform(F.filter(w, lambda t: t != "null"), address_token))


def address_core(tokens_: Column, admin: Column, norm: Column) -> Column:
    """All words (`norm`) but those of parts that name a region, of which numbers stay."""
    left = F.transform(tokens_, lambda w, i: F.when(F.get(admin, i).isNull(), w).otherwise(F.filter(w, is_number)))
    return F.when(F.size(F.array_compact(admin)) == 0, norm).otherwise(F.array_join(F.flatten(left), " "))


def numbers(norm: Column) -> Column:
    """All runs of digits, in order, without leading zeros."""
    return F.transform(F.regexp_extract_all(norm, F.lit("([0-9]+)"), F.lit(1)), without_zeros)


def length_ratio(a: Column, b: Column) -> Column:
    """Shorter length over longer; 0 if both are empty."""
    low, high = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    return F.when(high > 0, low / F.when(high > 0, high).otherwise(1)).otherwise(F.lit(0.0))


def word_set(c: Column) -> Column:
    return F.array_distinct(tokens(c))


def jaccard(a: Column, b: Column, neither: float = -1.0) -> Column:
    """Jaccard similarity of word sets; -1 if both are empty."""
    union = F.size(F.array_union(word_set(a), word_set(b)))
    return F.when(union > 0, F.size(F.array_intersect(word_set(a), word_set(b))) / F.when(union > 0, union).otherwise(1)).otherwise(F.lit(neither))


def number_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of numbers; -1 if either side has none."""
    return F.when((a == "") | (b == ""), F.lit(-1.0)).otherwise(jaccard(a, b))


def number_share(a: Column, b: Column) -> Column:
    """Share of the first side's numbers that the second has; -1 if the first has none."""
    n = F.size(word_set(a))
    return F.when(n > 0, F.size(F.array_intersect(word_set(a), word_set(b))) / F.when(n > 0, n).otherwise(1)).otherwise(F.lit(-1.0))


def equal3(a: Column, b: Column) -> Column:
    """1 equal, 0 different, -1 if either is empty."""
    return F.when((a == "") | (b == ""), -1.0).when(a == b, 1.0).otherwise(0.0)


def admin_equal(a: Column, b: Column, exact: bool = False) -> Column:
    """1 if the regions share a word (with exact: are the same text), 0 if not, -1 if either is empty."""
    same = a == b if exact else F.arrays_overlap(tokens(a), tokens(b))
    return F.when((a == "") | (b == ""), -1.0).when(same, 1.0).otherwise(0.0)
