"""Best-fit packing by the configuration linear program over the histogram of lengths.

A configuration is a multiset of lengths that fits a sequence. The program asks for the fewest sequences whose
configurations cover the histogram. Multiplicative weights give each length a price; the configurations of highest price
come from a knapsack dynamic program over the capacity; lengths that they cover get cheaper. The averaged configurations
are scaled to the histogram and rounded; what is left is packed best-fit, longest first, on the histogram too.

Only the histogram (at most `capacity` numbers) comes to the driver, whatever the size of the corpus. The plan that goes
back is a list of distinct configurations with multiplicities. Each piece finds its place by its rank among the pieces of
its length: ranks come from counts of (length, salt) groups of bounded size, so a length that a third of all pieces share
is spread over many tasks.

Null and empty texts have one piece, the separator alone. Texts of any length are cut into pieces of `capacity` tokens and
a shorter last one. Repeated rows are packed as rows of their own. An empty table gives an empty result. Other columns
of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkmill.llm._base import cut, map_batches, table

CAPACITY = 2048
SEPARATOR = 0
#: Pre-tokens that a worker remembers the ids of, in two generations of half as many each, and characters of the longest one.
CACHE, SHORT = 1_200_000, 48
#: Text of letters on which all Unicode versions agree: there the pre-tokens are those of PIECE, whatever stands between them.
FAST = re.compile("[\t\n\r -~¡-©«-±´¶-¸»¿-įı-ſ]*")
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\sa-z0-9ß-öø-ſ]+")


class Encoder:
    """Ids of whole texts as the library gives them. Pre-tokens are encoded independently, so each is encoded once and its
    packed ids are remembered; other text goes to the library as a whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.asarray(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if "<|" in text or FAST.fullmatch(text) is None:
            return self.pack(self.library.encode(text, add_special_tokens=False).ids)
        pieces = PIECE.findall(text.lower())
        found = list(map(self.young.get, pieces))
        if None in found:
            lost = {p for p, f in zip(pieces, found, strict=True) if f is None}
            own = {p: f for p in lost if (f := self.old.get(p)) is not None}
            new = [p for p in lost if p not in own]
            own.update(zip(new, (self.pack(e.ids) for e in self.library.encode_batch_fast(new, add_special_tokens=False)), strict=True))
            if len(self.young) + len(own) > CACHE // 2:
                self.young, self.old = {}, self.young
            self.young.update((p, f) for p, f in own.items() if len(p) <= SHORT)
            found = [own[p] if f is None else f for p, f in zip(pieces, found, strict=True)]
        return b"".join(found)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each piece of each row."""

    def make():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own = encoder(path or default_path())
        end = np.asarray([SEPARATOR], "<u4").tobytes()

        def work(batch):
            row, piece, start, length, crc = array("q"), array("q"), array("q"), array("q"), array("q")
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = own.encode(text or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row.append(i), piece.append(k), start.append(at // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))  # noqa: B018
            n = lambda x: np.frombuffer(x, np.int64) if len(x) else np.zeros(0, np.int64)
            yield [batch.column(0).take(_arrow(n(row))), n(piece).astype(np.int32), n(start), n(length), n(crc)]

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, ["doc_id", "text"], f"doc_id {kind}, piece int, start long, length long, ids_crc32 long", make)


def _arrow(x):
    import pyarrow as pa

    return pa.array(x)


def knapsack(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """By dynamic programming, for each c up to the capacity: the highest price that fits c, and the length to start with
    (the longest of equal ones; -1: as for c - 1). A length may be used again and again (unbounded knapsack)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := fits[c]:
            value = best[c - lengths[:k]] + prices[:k]
            j = k - 1 - value[::-1].argmax()
            if value[j] > best[c]:
                best[c], pick[c] = value[j], j
    return best, pick


def best_configuration(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Copies of each length in the configuration of highest price."""
    pick = knapsack(prices, lengths, capacity)[1]
    copies, c = np.zeros(len(lengths), np.int64), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            copies[pick[c]] += 1
            c -= int(lengths[pick[c]])
    return copies


def _with(first: int, best: np.ndarray, pick: np.ndarray, prices: np.ndarray, lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple:
    """((length's place, copies), ...) of the configuration of highest price that holds the given length. Where the table
    asks for more copies than the histogram has, the best of the other lengths goes on."""
    copies, c = {first: 1}, capacity - int(lengths[first])
    while c > 0:
        j = int(pick[c])
        if j < 0:
            c -= 1
            continue
        if copies.get(j, 0) >= counts[j]:
            k = int(np.searchsorted(lengths, c, "right"))
            value = best[c - lengths[:k]] + prices[:k]
            for i, n in copies.items():
                if i < k and n >= counts[i]:
                    value[i] = -1
            j = k - 1 - int(value[::-1].argmax())
            if value[j] <= 0:
                break
        copies[j] = copies.get(j, 0) + 1
        c -= int(lengths[j])
    return tuple(sorted(copies.items()))


def solve(lengths: np.ndarray, counts: np.ndarray, capacity: int, rate: float = 20.0, near: float = 0.02) -> list[tuple[tuple, float]]:
    """(configuration, number of sequences) of a fractional cover of the counts, by multiplicative weights over all lengths.

    The price of a length starts as the length and falls exponentially in how much of its count is covered. A round takes,
    for each length, the best configuration that holds it, if its price is within `near` of the highest, in proportion to
    the length's count, and as often as covers `step` of the count of the length that is covered most. At the end the
    numbers are scaled so that the least covered length is covered. Small programs get more and shorter rounds."""
    rounds = int(np.clip(8_000_000 // (capacity * len(lengths)), 400, 2000))
    need, covered, used, step, done = counts.astype(float), np.zeros(len(lengths)), {}, 40 / rounds, 0
    while done < rounds or covered.min() <= 0:
        prices = lengths * np.exp(-rate * (covered - covered.min()))
        best, pick = knapsack(prices, lengths, capacity)
        close = np.flatnonzero(prices + best[capacity - lengths] >= (1 - near) * best[capacity])
        configs = [(_with(int(j), best, pick, prices, lengths, counts, capacity), need[j]) for j in close]
        more = np.zeros(len(lengths))
        for config, n in configs:
            for i, k in config:
                more[i] += k * n
        more /= need
        times = step / more.max()
        for config, n in configs:
            used[config] = used.get(config, 0.0) + n * times
        covered += times * more
        done += 1
    return [(c, n / covered.min()) for c, n in sorted(used.items(), key=lambda x: (-x[1], x[0]))]


def plan(lengths: np.ndarray, counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences), which use up the histogram exactly: the rounded solution of
    the program, and best-fit for the remainder."""
    left = counts.astype(np.int64).copy()
    made: dict[tuple[int, ...], int] = {}

    def use(config: np.ndarray, times: int) -> None:
        key = tuple(int(x) for x in np.repeat(lengths, config)[::-1])
        made[key] = made.get(key, 0) + times
        np.subtract(left, config * times, out=left)

    full = np.flatnonzero(lengths == capacity)
    if len(full):  # a full piece is a sequence
        own = np.zeros(len(lengths), np.int64)
        own[full[0]] = 1
        use(own, int(left[full[0]]))
    open_ = np.flatnonzero(left)
    carried = 0.0  # what rounding down leaves of a number goes to the next configuration
    for config, n in solve(lengths[open_], left[open_], capacity) if len(open_) else ():
        carried += n
        times = int(carried)
        carried -= times
        if times:
            times = min(times, *(int(left[open_[i]]) // k for i, k in config))
        if times:
            copies = np.zeros(len(lengths), np.int64)
            copies[open_[[i for i, _ in config]]] = [k for _, k in config]
            use(copies, times)
    while left.any():  # what is left, best-fit: the longest that fits goes first
        config, room = np.zeros(len(lengths), np.int64), capacity
        while len(fits := np.flatnonzero((left > config) & (lengths <= room))):
            config[fits[-1]] += 1
            room -= int(lengths[fits[-1]])
        on = config > 0
        use(config, int((left[on] // config[on]).min()))
    return sorted(made.items(), reverse=True)


class Places:
    """Where the r-th piece of a length goes, as sorted arrays: a run of ranks for each place of a configuration."""

    def __init__(self, made: list[tuple[tuple[int, ...], int]]):
        runs, base = [], 0
        for config, times in made:
            offset = 0
            for length in config:
                runs.append((length, times, base, offset))
                offset += length
            base += times
        runs.sort()
        a = np.array(runs, np.int64).reshape(-1, 4)
        self.length, self.base, self.offset = a[:, 0], a[:, 2], a[:, 3]
        total = np.cumsum(a[:, 1]) - a[:, 1]
        first = np.searchsorted(self.length, self.length, "left")
        self.start = total - total[first] if len(a) else total  # first rank of the run within its length
        self.sequences = base

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of each piece."""
        key = self.length * (1 << 44) + self.start
        run = np.searchsorted(key, length * (1 << 44) + rank, "right") - 1
        return self.base[run] + rank - self.start[run], self.offset[run]


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all rows with sequence_id and offset. Tokens are made once; their digests are kept in the shared folder."""
    spark = docs.sparkSession
    parts = cut(pieces(docs, path, capacity))
    histogram = sorted((r["length"], r["n"]) for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect())
    lengths, counts = np.array([h[0] for h in histogram], np.int64), np.array([h[1] for h in histogram], np.int64)
    shared = spark.sparkContext.broadcast(Places(plan(lengths, counts, capacity)) if histogram else None)
    # Groups of (length, salt) hold some hundred pieces, or a small part of what a task gets, whichever is more.
    size = max(256, int(counts.sum()) // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    salts = F.create_map(*(F.lit(int(x)) for h, n in histogram for x in (h, -(-n // size)))) if histogram else F.create_map(F.lit(0), F.lit(1))
    salted = parts.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), salts[F.col("length").cast("int")].cast("long")))
    groups = salted.groupBy("length", "__salt").agg(F.count("*").alias("__n"))
    before = groups.select("length", "__salt", (F.sum("__n").over(Window.partitionBy("length").orderBy("__salt")) - F.col("__n")).alias("__before"))
    inside = Window.partitionBy("length", "__salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("__inside", F.row_number().over(inside) - 1)
        .join(before, ["length", "__salt"])
        .withColumn("__rank", F.col("__inside") + F.col("__before"))
    )

    def make():
        def work(batch):
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            sequence, offset = shared.value.of(length, rank)
            yield [*batch.columns[:5], sequence, offset]

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return map_batches(ranked, [*columns, F.col("__rank").cast("long")], f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long", make)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
