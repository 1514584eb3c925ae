"""Sharding by histogram sort: shards are ranges of one key order, of near-equal bytes.

Rows are ordered by (hash of the text, id), so equal texts stand together. Splitters are found by counting, not by
sampling: each round counts the exact bytes between candidate boundaries over all partitions, and narrows the bracket of
each splitter to the interval that holds its target, shrunk to the keys that occur there, until a boundary meets the
tolerance. A boundary between two texts is preferred, which keeps a group of equal texts in one shard; only where a group
is so large that no such boundary is near enough does the search go on between the ids of that group. Then the rows are
exchanged once, to several ranges for each shard, and sorted there; a row's slot is its rank in its shard.

A round moves one row of each task for each interval between boundaries, whose number depends on the number of ranges and not on the
corpus. Null texts count as empty ones (size 1); repeated rows are rows of their own, next to each other; null ids come
first. An empty table gives an empty result. Other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkmill.llm._base import cut, map_batches, table

SHARDS = 8
#: Part of a shard's bytes by which a boundary between texts may miss its target; the same where the nearest boundaries
#: between texts are known, so that going on would cut a group of equal texts; and for a boundary inside such a group.
TEXT_TOLERANCE, GROUP_TOLERANCE, ROW_TOLERANCE = 0.003, 0.02, 0.0005
#: The same for boundaries inside a shard, as a part of a range's bytes: they only balance tasks.
INNER_TOLERANCE = 0.25
PROBES = 16
_HALF, _WORD = 1 << 63, 1 << 64


def pack(h: int, d: int) -> int:
    """One number that orders like (h, d); both are signed 64-bit numbers."""
    return (h + _HALF) * _WORD + d + _HALF


def unpack(key: int) -> tuple[int, int]:
    return key // _WORD - _HALF, key % _WORD - _HALF


def intervals(h: np.ndarray, d: np.ndarray, bh: np.ndarray, bd: np.ndarray) -> np.ndarray:
    """Number of boundaries (bh, bd) that are not above each key (h, d)."""
    low, high = np.searchsorted(bh, h, "left"), np.searchsorted(bh, h, "right")
    out = low.copy()
    for x in np.unique(h[high > low]):
        own = h == x
        a, b = low[own][0], high[own][0]
        out[own] = a + np.searchsorted(bd[a:b], d[own], "right")
    return out


class Splitter:
    """A target in bytes, and the bracket of keys that its boundary is searched in."""

    def __init__(self, target: float, text_tolerance: float, group_tolerance: float, row_tolerance: float):
        self.target, self.text_tolerance, self.group_tolerance, self.row_tolerance = target, text_tolerance, group_tolerance, row_tolerance
        self.low, self.high = 0, _WORD * _WORD  # boundaries
        self.low_bytes = self.high_bytes = None
        self.key: int | None = None

    def probes(self, n: int) -> list[int]:
        low, high = self.low, self.high
        if high // _WORD - low // _WORD > 1:  # between texts
            a, b = low // _WORD, -(-high // _WORD)
            return sorted({min(max(_WORD * (a + (b - a) * i // n), low), high) for i in range(1, n)} | {low, high})
        mid = -(-low // _WORD) * _WORD  # one text, or the end of one and the start of the next
        return sorted({low + (high - low) * i // n for i in range(1, n)} | {low, high} | ({mid} if low <= mid <= high else set()))

    def narrow(self, keys: list[int], below: list[int], least: list, most: list) -> None:
        """keys: all boundaries in order; below: bytes below each; least, most: keys that occur from each to the next."""
        at = bisect_right(below, self.target) - 1
        near = [i for i in (at, at + 1) if 0 <= i < len(keys)]
        between_texts = [i for i in near if keys[i] % _WORD == 0]
        for found, tolerance in ((between_texts, self.text_tolerance), (near, self.row_tolerance)):
            best = min(found, key=lambda i: abs(below[i] - self.target), default=None)
            if best is not None and abs(below[best] - self.target) <= tolerance:
                self.key = keys[best]
                return
        if at < 0 or at + 1 >= len(keys) or least[at] is None:
            self.key = keys[max(0, min(at, len(keys) - 1))]
            return
        if least[at] == most[at]:  # one key; it can't be cut
            self.key = keys[at] if self.target - below[at] <= below[at + 1] - self.target else keys[at + 1]
            return
        if least[at] // _WORD == most[at] // _WORD:
            start = least[at] // _WORD * _WORD
            sides = [(abs(below[at] - self.target), start), (abs(below[at + 1] - self.target), start + _WORD)]
            if keys[at] <= start and start + _WORD <= keys[at + 1] and min(sides)[0] <= self.group_tolerance:
                self.key = min(sides)[1]
                return
            self.low, self.high = least[at], most[at] + 1
        else:  # from the start of the first text to the end of the last
            self.low, self.high = max(keys[at], least[at] // _WORD * _WORD), min(keys[at + 1], (most[at] // _WORD + 1) * _WORD)


def _assign(rows: DataFrame, boundaries: list[int], columns: list[str], ddl: str) -> DataFrame:
    """The columns and the interval of each row. Boundaries are as many as asked for, whatever the size of the table."""
    pairs = [unpack(b) for b in boundaries]
    shared = rows.sparkSession.sparkContext.broadcast((np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)))

    def make():
        bh, bd = shared.value

        def work(batch):
            h, d = (batch.column(i).to_numpy() for i in (0, 1))
            yield [*batch.columns, intervals(h, d, bh, bd)]

        return work

    return map_batches(rows, ["h", "d", *columns], f"h long, d long, {ddl}, at long", make)


def _counted(rows: DataFrame, boundaries: list[int]) -> list:
    """(at, rows, bytes, least, most) of each interval between boundaries that holds a key. A task folds its rows to one for
    each interval, so that only these are exchanged and sorted."""
    pairs = [unpack(b) for b in boundaries]
    shared = rows.sparkSession.sparkContext.broadcast((np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)))

    def make():
        (bh, bd), held = shared.value, {}

        def work(batch):
            if batch is None:
                if held:
                    yield [list(held), *([x[k] for x in held.values()] for k in range(2)), *([x[k][j] for x in held.values()] for k in (2, 3) for j in (0, 1))]
                return
            h, d, size = (c.to_numpy() for c in batch.columns)
            order = np.lexsort((d, h))
            h, d, size = h[order], d[order], size[order]
            at = intervals(h, d, bh, bd)  # grows with the key
            start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else at
            end = np.append(start[1:], len(at))
            total = np.add.reduceat(size, start) if len(at) else at
            for i, a, b, n in zip(at[start].tolist(), start.tolist(), end.tolist(), total.tolist(), strict=True):
                low, high = (int(h[a]), int(d[a])), (int(h[b - 1]), int(d[b - 1]))
                old = held.get(i, (0, 0, low, high))
                held[i] = (old[0] + b - a, old[1] + n, min(old[2], low), max(old[3], high))

        return work

    folded = map_batches(rows, ["h", "d", "size"], "at long, c long, n long, lh long, ld long, mh long, md long", make, ended=True)
    return folded.groupBy("at").agg(F.sum("c").alias("c"), F.sum("n").alias("n"), F.min(F.struct("lh", "ld")).alias("least"), F.max(F.struct("mh", "md")).alias("most")).collect()


def splitters(rows: DataFrame, ranges: int, per_shard: int, total: int, probes: int = PROBES) -> list[int]:
    """ranges - 1 boundaries over rows (h, d, size), each per_shard-th of them within the shards' tolerance."""
    one, shard = total / ranges, total / ranges * per_shard
    found = []
    for i in range(1, ranges):
        inner = i % per_shard
        found.append(Splitter(i * one, *((one * INNER_TOLERANCE,) * 3 if inner else (shard * TEXT_TOLERANCE, shard * GROUP_TOLERANCE, shard * ROW_TOLERANCE))))
    first = True
    while any(s.key is None for s in found):
        open_ = [s for s in found if s.key is None]
        # in the first round all brackets are the same one: evenly spaced over all keys
        keys = sorted({k for s in ([open_[0]] if first else open_) for k in s.probes(probes * (len(open_) if first else 1))})
        keys = sorted({min(k, _WORD * _WORD - 1) for k in keys} | {0})
        first = False
        counted = _counted(rows, keys)
        size, least, most = [0] * (len(keys) + 1), [None] * (len(keys) + 1), [None] * (len(keys) + 1)
        for r in counted:
            size[r["at"]], least[r["at"]], most[r["at"]] = r.n, pack(*r.least), pack(*r.most)
        below, sum_ = [], 0
        for i in range(len(keys)):
            sum_ += size[i]
            below.append(sum_)
        # a boundary above all keys, for targets in the last interval
        for s in open_:
            s.narrow([*keys, _WORD * _WORD], [*below, total], least[1:], most[1:])
    out = sorted(min(s.key, _WORD * _WORD - 1) for s in found)
    return out


def histogram_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row, by the law of near-equal bytes."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    integral = docs.schema["doc_id"].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))) if integral else F.xxhash64("doc_id")
    rows = cut(docs.select(F.xxhash64(text).alias("h"), order.alias("d"), "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")))
    total = rows.agg(F.sum("size").alias("n")).first().n or 0
    per_shard = max(1, min(512, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards)))
    found = splitters(rows.select("h", "d", "size"), shards * per_shard, per_shard, total) if total else []
    kind = docs.schema["doc_id"].dataType.simpleString()
    placed = _assign(rows, found, ["doc_id", "size", "text_crc32"], f"doc_id {kind}, size long, text_crc32 long")
    counts = {r["at"]: r.c for r in _counted(rows, found)} if total else {}
    before, base = [], 0
    for i in range(shards * per_shard):
        base = 0 if i % per_shard == 0 else base
        before.append((i, i // per_shard, base))
        base += counts.get(i, 0)
    ranges = spark.createDataFrame(before, "at long, shard int, __before long")
    rank = F.row_number().over(Window.partitionBy("at").orderBy("h", "d", "doc_id")) - 1
    return placed.withColumn("__rank", rank).join(F.broadcast(ranges), "at").select("doc_id", "size", "text_crc32", "shard", (F.col("__rank") + F.col("__before")).alias("slot"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
