"""Token counts by prefix dynamic programming over a byte-level BPE vocabulary.

For a pre-token, entry i of the table holds the last token of the encoding of its first i bytes and the number of tokens
of that encoding. Entry i follows from an earlier one: of the vocabulary's tokens that end at byte i (an Aho-Corasick
automaton of the vocabulary tells them), exactly one goes together with the last token before it, that is, the two stay as
they are when their joint bytes are encoded. One pass thus gives the exact count of every prefix, in time linear in the text,
and a stored table of them answers truncation and budget questions without encoding anything again.

Special strings cut a text into sections, and are a token each. Sections are cut where a run of white space begins, which no
pre-token crosses; counts of short chunks and of their pre-tokens are remembered, up to CACHE entries of either a worker.
Letters on which all Unicode versions agree are cut into pre-tokens here, other text by the library's pre-tokenizer; the
library encodes nothing.

Null and empty texts have zero tokens. Repeated rows get equal counts; long texts are read whole. Other columns of the
input are not read, so their names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm._base import map_batches, table

LIMIT = 1024
CACHE = 1_000_000
#: Characters of the longest chunk or pre-token that is remembered, so that what a worker holds is bounded in bytes.
SHORT = 48
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: White space as the pre-tokenizer sees it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f"[{SPACE}]+[^{SPACE}]*|[^{SPACE}]+")
RUN = re.compile(f"[{SPACE}]*")
#: A space before white space or the end: then the text can't simply be cut at its spaces.
LOOSE = re.compile(f" (?=[{SPACE}]|\\Z)")
#: Letters and marks on which all Unicode versions agree.
PLAIN = re.compile("[\t\n\r -~¡-ʯͰ-ϿЀ-ӿ‐-‧‰-⁞]*")


class PrefixCounter:
    """Exact counts of texts and of all their prefixes, as tokenizers.Tokenizer gives them for the same file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.vocab = frozenset(spec["model"]["vocab"])
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.ending = ahocorasick.Automaton()
        for token in self.vocab:
            self.ending.add_word(token, token)
        self.ending.make_automaton()
        # Byte-level vocabularies write each byte as one printable character.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.letter = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}
        self.together: dict[tuple[str, str], bool] = {}
        self.counts: dict[str, int] = {}
        self.words: dict[str, int] = {}

    def bytes_of(self, text: str) -> str:
        return text.encode("utf-8", "replace").decode("latin-1").translate(self.letter)

    def merge(self, word: str) -> list[str]:
        """Plain BPE: the earliest rule that applies, again and again."""
        parts = list(word)
        while len(parts) > 1:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == 1 << 60:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def fits(self, before: str, token: str) -> bool:
        key = (before, token)
        known = self.together.get(key)
        if known is None:
            if len(self.together) > CACHE:
                self.together.clear()
            known = self.together[key] = self.merge(before + token) == ([before, token] if before else [token])
        return known

    def prefixes(self, word: str) -> list[int]:
        """Token counts of the first 0, 1, ... bytes of one pre-token (given as letters of bytes)."""
        last, count, fits, end = [""], [0], self.fits, 0
        for at, token in self.ending.iter(word):  # all tokens that end at a byte, the longest first
            if at < end:
                continue  # the byte has its entry
            j = at + 1 - len(token)
            if at > end or j > end:
                break
            if fits(last[j], token):
                last.append(token)
                count.append(count[j] + 1)
                end += 1
        if end < len(word):
            raise ValueError(f"the vocabulary has no token for {word[end]!r}")
        return count

    def pieces(self, chunk: str) -> list[tuple[str, str]]:
        """The pre-tokens of a chunk, as text and as letters of bytes."""
        if PLAIN.fullmatch(chunk):
            return [(p, self.bytes_of(p)) for p in PRETOKEN.findall(chunk)]
        return [(chunk[a:b], letters) for letters, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(chunk)]

    def chunk(self, chunk: str) -> int:
        """Tokens of one chunk."""
        total, words = 0, self.words
        for _, p in self.pieces(chunk):
            n = words.get(p)
            if n is None:
                n = self.prefixes(p)[-1]
                if len(p) <= SHORT:
                    if len(words) > CACHE:
                        words.clear()
                    words[p] = n
            total += n
        return total

    def remembered(self, chunk: str) -> int:
        n = self.counts.get(chunk)
        if n is None:
            n = self.chunk(chunk)
            if len(chunk) <= SHORT:
                if len(self.counts) > CACHE:
                    self.counts.clear()
                self.counts[chunk] = n
        return n

    def inside(self, chunk: str) -> list[int]:
        """Tokens of the first 0, 1, ... characters of a chunk."""
        out, base = [0], 0
        for piece, letters in self.pieces(chunk):
            counts, at = self.prefixes(letters), 0
            for i, letter in enumerate(piece):
                at += len(letter.encode("utf-8", "replace"))
                # of 're, 've and 'll, the first two characters alone are two pre-tokens
                out.append(base + (2 if i == 1 and len(piece) == 3 and piece in ("'re", "'ve", "'ll") else counts[at]))
            base += counts[-1]
        run = RUN.match(chunk).group()
        counts, at = self.prefixes(self.bytes_of(run)), 0
        for i, letter in enumerate(run, 1):  # a prefix that ends in the white space is one pre-token
            at += len(letter.encode())
            out[i] = counts[at]
        return out

    def sections(self, text: str) -> Iterator[tuple[str, str]]:
        """(ordinary text, the special string after it) until the end, where there is none."""
        at = 0
        for m in self.special.finditer(text):
            yield text[at : m.start()], m.group()
            at = m.end()
        yield text[at:], ""

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if self.special.search(text):
            return sum(self._count(t) + (s != "") for t, s in self.sections(text))
        return self._count(text)

    def _count(self, text: str) -> int:
        if LOOSE.search(text):
            return sum(map(self.remembered, CHUNK.findall(text)))
        pieces = text.split(" ")
        total = self.remembered(pieces[0]) if pieces[0] else 0
        get, again = self.counts.get, self.remembered
        for p in pieces[1:]:
            n = get(p := " " + p)
            total += again(p) if n is None else n
        return total

    def table(self, text: str) -> np.ndarray:
        """Tokens of the first 0, 1, ... characters of a text: the stored table."""
        out, base = [0], 0
        for ordinary, special in self.sections(text):
            chunks = CHUNK.findall(ordinary)
            for chunk in chunks:
                inside = self.inside(chunk)
                out += [base + n for n in inside[1:]]
                base += inside[-1]
            if special:  # less than the whole string is ordinary text, and goes on with the chunk before it
                chunk = chunks[-1] if chunks else ""
                before = base - (out[-1] - out[-1 - len(chunk)] if chunk else 0)
                inside = self.inside(chunk + special[:-1])
                out += [before + n for n in inside[len(chunk) + 1 :]]
                base += 1
                out.append(base)
        return np.array(out, np.int32)


def cut(table: np.ndarray, limit: int) -> int:
    """Characters of the longest prefix of at most `limit` tokens, by the stored table. A longer prefix may have fewer tokens
    than a shorter one, so the last entry within the limit counts."""
    return int(np.flatnonzero(table <= limit)[-1])


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One for each worker and file, so that what it remembers serves all its tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _make(path: str | None, work):
    return lambda: lambda batch: work(counter(path or default_path()), batch)


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens for every row."""

    def work(c, batch):
        texts = [t or "" for t in batch.column(1).to_pylist()]
        yield [batch.column(0), [len(t.encode("utf-8", "replace")) for t in texts], list(map(c.count, texts))]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, ["doc_id", "text"], f"doc_id {kind}, n_bytes long, n_tokens long", _make(path, work))


def prefix_tables(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the stored table of every row: tokens[i] is the token count of the first i characters, so that any budget
    question is a look-up."""

    def work(c, batch):
        for i, text in enumerate(batch.column(1).to_pylist()):
            yield [batch.column(0).slice(i, 1), [c.table(text or "")]]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, ["doc_id", "text"], f"doc_id {kind}, tokens array<int>", _make(path, work))


def truncated(docs: DataFrame, limit: int, path: str | None = None) -> DataFrame:
    """doc_id and text cut to the longest prefix of at most `limit` tokens; null stays null."""

    def work(c, batch):
        texts = batch.column(1).to_pylist()
        yield [batch.column(0), [None if t is None else t[: cut(c.table(t), limit)] for t in texts]]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, ["doc_id", "text"], f"doc_id {kind}, text string", _make(path, work))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > LIMIT)
