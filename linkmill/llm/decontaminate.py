"""Benchmark decontamination with an FM-index for each shard of the training texts.

A shard is a bounded run of rows of one partition. Its texts become word numbers over the benchmark's vocabulary; a word
outside of it cannot be part of any window, so runs of benchmark words, long enough for the shortest window, are what is
indexed. The index is the Burrows-Wheeler transform of the shard in a wavelet matrix, with suffix positions sampled.
All test windows are searched backward at once; rows of non-empty intervals are walked to sampled positions, which gives
every occurrence, and the occurrences of a text are merged into removal spans.

A window is `width` consecutive words of an item; an item of fewer words, but not none, is one window. The benchmark is
shipped to the workers in blocks of about BLOCK_CHARS characters, dealt by hashes; a larger one takes several passes, each
over all texts, with the same results.
Nothing is shuffled.

Nulls and texts without words have no hits. Repeated rows get equal results. Texts of any length are read whole, and are
never split over shards. Items with a null text have no windows; a null item_id counts as the empty string. An empty
benchmark contaminates nothing. Other columns of the inputs are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm._base import map_batches, small_batches, table
from linkmill.llm._words import split_words

WIDTH = 10
#: Characters of benchmark text that go to the workers at once.
BLOCK_CHARS = 32_000_000
#: Words of one shard, but for a single longer text.
SHARD_WORDS = 1_000_000
SAMPLE = 8


class WaveletMatrix:
    """rank(symbol, i): occurrences of a symbol before place i, for arrays of both."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        low = np.zeros_like(i)
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            one = ((symbol >> level) & 1).astype(bool)
            a, b = self.ones[k][low], self.ones[k][i]
            low, i = np.where(one, self.zeros[k] + a, low - a), np.where(one, self.zeros[k] + b, i - b)
        return i - low


class FMIndex:
    """Over runs of symbols from 1 that zeros separate; a zero also ends the text."""

    def __init__(self, text: np.ndarray, bits: int):
        n = len(text)
        order = self._suffixes(text)
        before = text[order - 1]  # the last symbol, a zero, stands before the first
        self.matrix, self.before = WaveletMatrix(before, bits), before
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=1 << bits))))  # rows of smaller symbols
        # A walk to the left ends at a run's start at the latest, so that it never crosses a separator.
        kept = (order % SAMPLE == 0) | (before == 0)
        self.sampled = np.where(kept, order, -1)
        self.rows = n

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """Suffix order by prefix doubling. Each separator counts as a symbol of its own, smaller than all words."""
        n = len(text)
        zero = text == 0
        rank = np.where(zero, np.cumsum(zero) - 1, text + int(zero.sum())).astype(np.int64)
        k = 1
        while True:
            after = np.zeros(n, np.int64)
            after[: n - k] = rank[k:] + 1 if k < n else 0
            # what follows a separator doesn't matter: its rank is its own
            key = rank * (int(rank.max()) + 2) + after
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            rank = new
            if int(rank.max()) == n - 1:
                return order
            k *= 2

    def search(self, ids: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of rows whose suffixes begin with each pattern, the `size` symbols of `ids` from each start. Only patterns
        all of whose symbols stand in the text are searched; the others' intervals are empty."""
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.rows, np.int64)
        known = np.concatenate(([0], np.cumsum(np.diff(self.first)[ids] > 0, dtype=np.int32)))
        live = np.flatnonzero(known[starts + size] - known[starts] == size)
        for column in range(size - 1, -1, -1):
            s = ids[starts[live] + column]
            low[live] = self.first[s] + self.matrix.rank(s, low[live])
            high[live] = self.first[s] + self.matrix.rank(s, high[live])
            live = live[high[live] > low[live]]
            if not len(live):
                break
        none = np.ones(len(starts), bool)
        none[live] = False
        high[none] = low[none]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by steps to the left until a sampled row."""
        rows, steps, out = rows.copy(), 0, np.full(len(rows), -1, np.int64)
        left = np.arange(len(rows))
        while len(left):
            at = self.sampled[rows[left]]
            done = at >= 0
            out[left[done]] = at[done] + steps
            left = left[~done]
            r = rows[left]
            s = self.before[r]
            rows[left] = self.first[s] + self.matrix.rank(s, r)
            steps += 1
        return out


class Windows:
    """The distinct windows of a block of benchmark items, by length, with the items that hold each. Windows are places in one
    array of word numbers, and items are numbers, so that a block takes some twenty bytes a word besides its vocabulary."""

    def __init__(self, items: Iterable[tuple[str, str | None]], width: int = WIDTH):
        self.number: dict[bytes, int] = {}
        of: dict[str, int] = {}
        parts, lengths, owners = [], [], []
        for name, text in items:
            words = split_words(text)
            if words:
                parts.append(np.fromiter((self.number.setdefault(w, len(self.number) + 1) for w in words), np.int32, len(words)))
                lengths.append(len(words))
                owners.append(of.setdefault(name, len(of)))
        self.names, self.ids = list(of), np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.bits = max(1, len(self.number).bit_length())
        n, owner = np.array(lengths, np.int64), np.array(owners, np.int64)
        first, sizes = np.cumsum(n) - n, np.minimum(n, width)
        self.groups = [(size, *self._distinct(first[sizes == size], n[sizes == size] - size + 1, owner[sizes == size], size)) for size in np.unique(sizes).tolist()]
        self.least = self.groups[0][0] if self.groups else 0

    def _distinct(self, first: np.ndarray, count: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(a start of each distinct window, offsets into holders, holders) of `count` windows from each first place."""
        starts = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - first, count)
        same = self.ids[starts].astype(np.int64)
        for k in range(1, size):  # numbers of equal beginnings, longer by a word each time
            same = np.unique(same * (len(self.number) + 1) + self.ids[starts + k], return_inverse=True)[1]
        _, one, same = np.unique(same, return_index=True, return_inverse=True)
        held = np.unique(same * len(self.names) + np.repeat(owner, count))
        offsets = np.searchsorted(held // len(self.names), np.arange(len(one) + 1))
        return starts[one].astype(np.int32), offsets, (held % len(self.names)).astype(np.int32)

    def runs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, places) of runs of known words, at least as long as the shortest window; each run ends with a zero."""
        get = self.number.get
        ids = np.array([get(w, 0) for w in words], np.int64)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], ids > 0, [0])).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.least
        if not long.any():
            return ids[:0], ids[:0]
        places = np.concatenate([np.arange(a, b + 1) for a, b in zip(starts[long], ends[long], strict=True)])
        symbols = np.append(ids, 0)[places]
        return symbols, places

    def find(self, texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set]]:
        """(merged spans of words, items) of each text of a shard."""
        out: list[tuple[list, set]] = [([], set()) for _ in texts]
        parts = [(d, *self.runs(w)) for d, w in enumerate(texts) if w] if self.groups else []
        parts = [p for p in parts if len(p[1])]
        if not parts:
            return out
        text = np.concatenate([p[1] for p in parts])
        doc = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts])
        place = np.concatenate([p[2] for p in parts])
        index = FMIndex(text, self.bits)
        for size, starts, offsets, holders in self.groups:
            low, high = index.search(self.ids, starts, size)
            hit = np.flatnonzero(high > low)
            if not len(hit):
                continue
            count = (high - low)[hit]
            rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[hit], count)
            at = index.locate(rows)
            for p, w in zip(at.tolist(), np.repeat(hit, count).tolist(), strict=True):
                spans, items = out[doc[p]]
                spans.append((int(place[p]), int(place[p]) + size))
                items.update(holders[offsets[w] : offsets[w + 1]].tolist())
        return [(merge(spans), {self.names[i] for i in items}) for spans, items in out]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, most: int) -> list[DataFrame]:
    """The benchmark in parts of about `most` characters; its size is measured first."""
    total = benchmark.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    n = int(total // most) + 1
    return [benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else benchmark for i in range(n)]


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, keep: tuple = ("doc_id",), block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The kept columns, n_words, spans (removal spans in words, half-open) and items (sorted ids as strings)."""
    spark, at = docs.sparkSession, len(keep)
    state = docs.select(*(F.col(f"`{c}`") for c in keep), F.col("text").alias("__text"), F.lit(None).cast("array<int>").alias("__spans"), F.lit(None).cast("array<string>").alias("__items"))
    ddl = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    blocks = _blocks(benchmark.select("item_id", "text"), block_chars)
    for i, block in enumerate(blocks):
        rows = block.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), "text").collect()
        shared = spark.sparkContext.broadcast(Windows(((r.i, r.text) for r in rows), width))  # at most block_chars

        def make(shared=shared, last=i == len(blocks) - 1):
            windows = shared.value

            def work(batch):
                texts, old, names = (batch.column(at + k).to_pylist() for k in range(3))
                done = 0
                while done < len(texts):
                    shard, words, first = [], 0, done
                    while done < len(texts) and (not shard or words < SHARD_WORDS):
                        shard.append(split_words(texts[done]))
                        words += len(shard[-1])
                        done += 1
                    found = windows.find(shard)
                    spans = [merge([*zip(o[::2], o[1::2], strict=True), *f[0]] if o else f[0]) for o, f in zip(old[first:done], found, strict=True)]
                    items = [sorted(f[1].union(o or ())) for o, f in zip(names[first:done], found, strict=True)]
                    own = [c.slice(first, done - first) for c in batch.columns[:at]]
                    if last:
                        yield [*own, [len(w) for w in shard], [[{"first": a, "end": b} for a, b in s] for s in spans], items]
                    else:
                        yield [*own, texts[first:done], [[x for s in sp for x in s] for sp in spans], items]

            return work

        end = "n_words long, spans array<struct<first: long, end: long>>, items array<string>"
        through = "__text string, __spans array<int>, __items array<string>"
        state = map_batches(state, ["*"], f"{ddl}, {end if i == len(blocks) - 1 else through}", make)
    return state


def contaminated_column(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_chars: int = BLOCK_CHARS):
    """Whether a text holds a window, as a column of docs; the other columns don't leave the JVM."""
    out = F.lit(False)
    small_batches(docs.sparkSession)
    for block in _blocks(benchmark.select("item_id", "text"), block_chars):
        rows = block.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), "text").collect()
        shared = docs.sparkSession.sparkContext.broadcast(Windows(((r.i, r.text) for r in rows), width))  # at most block_chars

        def run(texts: pd.Series, shared=shared) -> pd.Series:
            hit, done, texts = [], 0, texts.tolist()
            while done < len(texts):
                shard, words = [], 0
                while done < len(texts) and (not shard or words < SHARD_WORDS):
                    shard.append(split_words(texts[done]))
                    words += len(shard[-1])
                    done += 1
                hit += [bool(spans) for spans, _ in shared.value.find(shard)]
            return pd.Series(hit, dtype=bool)

        out = out | _boolean(run)(F.col("text"))
    return out


def _boolean(run):
    return F.pandas_udf(lambda texts: run(texts), "boolean")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def brute_force(texts: list, items: list[tuple[str, str | None]], width: int = WIDTH) -> list[tuple[int, int, int, str, bool]]:
    """The same digest by comparing every place with every window; for tests."""
    windows: dict[tuple, set] = {}
    for name, text in items:
        w = split_words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add(name)
    out = []
    for text in texts:
        w, hit, names = split_words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if (own := windows.get(tuple(w[i : i + size]))) is not None:
                    hit.update(range(i, i + size))
                    names |= own
        out.append((len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out
