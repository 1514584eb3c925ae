"""N-gram Jaccard join with signature trees.

Each text is a set of hashed word shingles. Rows with equal sets are one node of the link graph, so copies never form
pairs. Two sets that reach the threshold t share one of their first n - ceil(t n) + 1 shingles in any common order of all
shingles (prefix filtering); the order takes shingles that are common in a sample last and goes by hash otherwise, so the
sample decides about speed only, never about results. Blocks are the nodes that share such a shingle. The join of the
blocks takes two rounds:

1. Each node is compared with its block's smallest node, and with another one that a hash picks. Of a block of two, that
   is the only pair.
2. Blocks with the same smallest node are one cluster. Clusters that still hold several components are searched with
   signature trees: leaves are nodes' bitmaps, inner nodes hold the union of the bitmaps below them, the range of set
   sizes and the component if there is one. Two trees are walked together; a pair of tree nodes is dropped when the sizes
   can't reach t, when both lie in one component, or when the largest overlap that the bitmaps allow is too small.
   Clusters of over BLOCK nodes are cut, and each pair of parts is a task of its own. A component of BLOCK nodes and more
   has parts to itself, which never meet each other: a cluster of one large component and some other nodes costs in
   proportion to its size. The first walk, over small bitmaps, gives the nodes of pairs that may be links, not the pairs,
   which may be as many as the square of a cluster. Whole sets of these nodes go to a second walk, over wide bitmaps. It
   decides pairs on the sets, joins components as it finds links, and sends out only links that join two of them.

Pairs with a pivot are decided on the whole sets, too. Components come from alternating star contractions of the
links. Nothing unbounded is collected: blocks meet their counts by joins that can be split where they are skewed, rows of
large clusters and classes find their data under salts, and the driver sees counts, at most MOST common shingles of the
sample, and a bitmap that tells which texts are worth reading again, of 16 bits a wanted set and 2 ** MOST_SIEVE at most.

The query's components are those of all links. Links inside a component that is connected already are neither listed nor
counted. Nulls and texts without words have empty sets and are linked with nothing. Repeated rows share a component. A null doc_id takes
part, but is no component's name unless the component has no other. Texts of any length are read whole. Other columns of
the input are not read, so their names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm._base import cut, make_sieve, map_batches, passes, table

WIDTH, PERCENT = 4, 85
#: About so many documents decide which shingles are common, those of at least COMMON of them. Only hashes in the lowest
#: LOW part of all are counted: the order goes by hash, so others are seldom among the first.
ORDER_SAMPLE, COMMON, LOW = 32_768, 3, 0.35
#: Of them, the most frequent ones that the order knows: 16 MB.
MOST = 1 << 20
BLOCK = 1024
#: Shingles of a part of a cluster, but for a single larger set: 32 MB of whole sets.
BLOCK_SHINGLES = 1 << 22
#: Least bits for each shingle, at most twice as many: of bitmaps that are exchanged, and of those made where the sets are.
BITS, WIDE = 2, 8
SALTS = 16
#: Bytes of text that are hashed at once.
PART = 1 << 20
LEAF, FAN = 16, 8

_LOWER = bytes(32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_NEAR = _mix(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_FAR = _mix(np.arange(5001, 9097, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & ~np.uint64(1)
_TURN = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _word_hashes(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    inside = b != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    letters = b[inside].astype(np.uint64) + np.uint64(1)
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    place = np.arange(len(letters)) - np.repeat(begin, size)
    weight = _NEAR[place & 4095]
    if size.max() > 4096:
        weight = weight ^ _FAR[(place >> 12) & 4095]
    return _mix(np.add.reduceat(letters * weight, begin) + size.astype(np.uint64) * _TURN[0])


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word, in order; long texts are hashed in parts that end between words."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    parts, at = [], 0
    while at < len(raw):
        end = len(raw) if at + PART >= len(raw) else raw.find(b" ", at + PART)
        end = len(raw) if end < 0 else end
        parts.append(_word_hashes(raw[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes; of fewer words, the whole sequence as one."""
    w = word_hashes(text)
    if not len(w):
        return w
    k = min(width, len(w))
    s = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        s = s + w[i : len(w) - k + 1 + i] * _TURN[i % len(_TURN)] if i < len(_TURN) else _mix(s) + w[i : len(w) - k + 1 + i]
    return np.unique(_mix(s))


def signature(s: np.ndarray) -> int | None:
    """One number for a whole set; None for the empty one."""
    if not len(s):
        return None
    total = int(_mix(s ^ _TURN[1]).sum(dtype=np.uint64)) ^ len(s) * int(_TURN[2]) % (1 << 64)
    return total - (1 << 64) if total >> 63 else total


def prefix(s: np.ndarray, common: np.ndarray, often: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of a set, those that aren't common and those that are: one of them is in any set that reaches
    the threshold with it."""
    n = len(s)
    size = n - -(-n * percent // 100) + 1 if n else 0
    if not len(common):
        return s[:size], s[:0]
    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
    known = common[at] == s
    rare = s[~known][:size]
    rest, count = s[known], often[at[known]]
    return rare, rest[np.lexsort((rest, count))][: size - len(rare)]


def bitmap(s: np.ndarray, bits: int = BITS) -> bytes:
    """A bit for each shingle, in a power of two of bits, one to two times `bits` as many as shingles. The more bits, the fewer
    of the shingles that one of two sets lacks share a bit with others, and the closer is the bound on the overlap."""
    bits = 1 << max(6, min(23, math.ceil(math.log2(bits * (len(s) + 1)))))
    out = np.zeros(bits, np.uint8)
    out[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def fold(b: bytes, size: int) -> bytes:
    """The bitmap in fewer bytes: halves are united."""
    a = np.frombuffer(b, np.uint8)
    while len(a) > size:
        a = a[: len(a) // 2] | a[len(a) // 2 :]
    return a.tobytes()


def needed(n, m, percent: int = PERCENT):
    """Least overlap of sets of sizes n and m that reach the threshold: 100 x >= percent (n + m - x)."""
    return -(-(n + m) * percent // (100 + percent))


def possible(n: int, a: bytes, m: int, b: bytes, percent: int = PERCENT) -> bool:
    """Whether the bitmaps allow the threshold: a bit of one set alone is at least one shingle of it alone."""
    size = min(len(a), len(b))
    x, y = (int.from_bytes(fold(v, size), "little") for v in (a, b))
    return min(n - (x & ~y).bit_count(), m - (y & ~x).bit_count()) >= needed(n, m, percent)


class SignatureTree:
    """Static tree over the nodes of a block, ordered by set size; level 0 holds leaves of LEAF nodes."""

    def __init__(self, sizes: np.ndarray, maps: np.ndarray, components: np.ndarray):
        order = np.lexsort((components, sizes))
        self.order, self.sizes, self.maps, self.components = order, sizes[order], maps[order], components[order]
        spare = self.sizes - np.bitwise_count(self.maps).sum(1, dtype=np.int64)  # shingles beyond one for each bit
        rows = (self.maps, self.sizes, self.sizes, spare, self.components, self.components)
        self.levels = []
        fan = LEAF
        while True:
            cuts = np.arange(0, len(rows[0]), fan)
            rows = (
                np.bitwise_or.reduceat(rows[0], cuts), np.minimum.reduceat(rows[1], cuts), np.maximum.reduceat(rows[2], cuts),
                np.maximum.reduceat(rows[3], cuts), np.minimum.reduceat(rows[4], cuts), np.maximum.reduceat(rows[5], cuts),
            )
            self.levels.append(rows)
            if len(cuts) == 1:
                break
            fan = FAN

    def below(self, level: int, node: int) -> range:
        fan, n = (LEAF, len(self.sizes)) if level == 0 else (FAN, len(self.levels[level - 1][0]))
        return range(node * fan, min(n, (node + 1) * fan))


def dual_join(a: SignatureTree, b: SignatureTree, percent: int = PERCENT):
    """Pairs (i, j) of rows of a and b in different components that the bitmaps allow; with a is b, each pair once."""
    same = a is b
    stack = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while stack:
        la, x, lb, y = stack.pop()
        ma, lo_a, hi_a, spare_a, c0_a, c1_a = (v[x] for v in a.levels[la])
        mb, lo_b, hi_b, spare_b, c0_b, c1_b = (v[y] for v in b.levels[lb])
        if hi_a * 100 < percent * lo_b or hi_b * 100 < percent * lo_a or c0_a == c1_a == c0_b == c1_b:
            continue
        most = int(np.bitwise_count(ma & mb).sum()) + min(spare_a, spare_b)
        if most < needed(int(lo_a), int(lo_b), percent):
            continue
        if la == 0 and lb == 0:
            p, q = np.array(a.below(0, x)), np.array(b.below(0, y))
            u, v = a.maps[p][:, None], b.maps[q][None]
            left = a.sizes[p][:, None] - np.bitwise_count(u & ~v).sum(2, dtype=np.int64)
            right = b.sizes[q][None] - np.bitwise_count(v & ~u).sum(2, dtype=np.int64)
            ok = np.minimum(left, right) >= needed(a.sizes[p][:, None], b.sizes[q][None], percent)
            ok &= a.components[p][:, None] != b.components[q][None]
            if same:
                ok &= p[:, None] < q[None]
            for i, j in zip(*np.nonzero(ok), strict=True):
                yield int(a.order[p[i]]), int(b.order[q[j]])
        elif la >= lb:
            stack += [(la - 1, z, lb, y) for z in a.below(la, x)]
        else:
            stack += [(la, x, lb - 1, z) for z in b.below(lb, y)]


def block_pairs(sigs: np.ndarray, sizes: np.ndarray, maps: list[bytes], components: np.ndarray, parts: np.ndarray, i: int, j: int, percent: int = PERCENT):
    """Pairs of a block between its parts i and j (or within i). Trees hold bitmaps of one width; sets that can reach the
    threshold have bitmaps of the same width or of neighbouring ones, where the wider are folded."""
    widths = np.array([len(m) for m in maps])

    def tree(part: int, width: int, to: int):
        own = np.flatnonzero((parts == part) & (widths == width))
        if not len(own):
            return None
        m = np.frombuffer(b"".join(fold(maps[k], to) for k in own), np.uint64).reshape(len(own), -1)
        return SignatureTree(sizes[own], m, components[own]), sigs[own]

    for w in np.unique(widths).tolist():
        a, b = tree(i, w, w), tree(j, w, w)
        joins = [(a, a if i == j else b), (a, tree(j, 2 * w, w))]
        if i != j:
            joins.append((tree(i, 2 * w, w), b))
        for x, y in joins:
            if x is not None and y is not None:
                for p, q in dual_join(x[0], y[0], percent):
                    yield int(x[1][p]), int(y[1][q])


class BlockStream:
    """Rows (token, sig, n) that come sorted, batch after batch, to rows (token, sig, n, pivot, m) of blocks of two nodes
    and more. Of a block, the first row alone is remembered."""

    def __init__(self):
        self.token = self.sig = self.pivot = self.m = None
        self.sent = False  # whether the block's pivot has gone out

    def take(self, token: np.ndarray, sig: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        if not len(token):
            return [token[:0]] * 5
        goes_on = token[0] == self.token
        first = np.concatenate(([not goes_on], token[1:] != token[:-1]))
        copy = np.concatenate(([goes_on and sig[0] == self.sig], (token[1:] == token[:-1]) & (sig[1:] == sig[:-1])))
        start = np.maximum.accumulate(np.where(first, np.arange(len(token)), -1))  # -1: in the block that goes on
        pivot = np.where(start >= 0, sig[start], self.pivot or 0)
        m = np.where(start >= 0, n[start], self.m or 0)
        later = ~first & ~copy
        starts = np.unique(start[later])
        own = starts[starts >= 0]
        out = [[token[own], sig[own], n[own], sig[own], n[own]], [x[later] for x in (token, sig, n, pivot, m)]]
        grew = bool(len(starts)) and starts[0] < 0
        if grew and not self.sent:
            out.append([np.array([x]) for x in (self.token, self.pivot, self.m, self.pivot, self.m)])
        self.sent = (self.sent or grew) if start[-1] < 0 else bool(start[-1] in own)
        self.token, self.sig, self.pivot, self.m = int(token[-1]), int(sig[-1]), int(pivot[-1]), int(m[-1])
        return [np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True)]


# Plans


def _common(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several documents of a sample of about ORDER_SAMPLE, and how often they occur there."""
    n = docs.count()
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < ORDER_SAMPLE)

    def make():
        def low(t):
            s = shingle_set(t, width)
            return s[: np.searchsorted(s, np.uint64(int(LOW * 2**64)))].astype(np.int64)

        return lambda batch: iter([[[low(t) for t in batch.column(0).to_pylist()]]])

    sets = map_batches(sample, ["text"], "s array<long>", make)
    counted = sets.select(F.explode("s").alias("s")).groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    rows = counted.orderBy(F.desc("n"), "s").limit(MOST).toPandas()
    s, often = rows["s"].to_numpy(np.int64).astype(np.uint64), rows["n"].to_numpy(np.int64)
    order = np.argsort(s)
    return s[order], often[order]


def _digests(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, hash of the text, n, sig, bitmap and the two parts of the prefix of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(_common(docs, width))

    def make():
        common, often = shared.value

        def work(batch):
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [shingle_set(t, width) for t in part.column(2).to_pylist()]
                prefixes = [prefix(s, common, often, percent) for s in sets]
                yield [part.column(0), part.column(1), list(map(len, sets)), list(map(signature, sets)), list(map(bitmap, sets)), *([p[k].astype(np.int64) for p in prefixes] for k in (0, 1))]

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, ["doc_id", _text_hash(), "text"], f"doc_id {kind}, text_hash long, n long, sig long, map binary, rare array<long>, common array<long>", make)


def _text_hash():
    """Tells whether a text is worth reading again, before it is cut into shingles."""
    return F.xxhash64("text").alias("text_hash")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """sig and the whole set of each wanted signature (with the hash of a text that has it), from another scan of the texts.
    Texts that the sieve holds back are not cut into shingles; a task sends a set once, however many copies it meets; a join
    drops the sets of other texts that passed."""
    shared = docs.sparkSession.sparkContext.broadcast(make_sieve(wanted.select("text_hash")))

    def make():
        sieve, sent = shared.value, set()

        def work(batch):
            h = batch.column(0).to_numpy()
            for at in np.flatnonzero(passes(sieve, h)).tolist():
                if int(h[at]) not in sent:
                    sent.add(int(h[at]))
                    s = shingle_set(batch.column(1)[at].as_py(), width)
                    if len(s):
                        yield [[signature(s)], [s.astype(np.int64)]]

        return work

    sets = map_batches(docs, [_text_hash(), "text"], "sig long, shingles array<long>", make)
    return sets.join(wanted, "sig", "left_semi").groupBy("sig").agg(F.first("shingles").alias("shingles"))


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    ends = cut(pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct().join(nodes.select("sig", "text_hash"), "sig"))
    sets = cut(_sets(docs, ends, width))
    both = pairs.join(sets.select(F.col("sig").alias("b"), F.col("shingles").alias("y")), "b").join(sets.select(F.col("sig").alias("a"), F.col("shingles").alias("x")), "a")
    inter = F.size(F.array_intersect("x", "y"))
    return both.where(100 * inter >= percent * (F.size("x") + F.size("y") - inter)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of each node that has a link; the component is its smallest node. Alternating star contractions."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        edges = cut(small)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("sig"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("sig"), F.col("v").alias("component")).distinct())
        before = now


def _blocks(digests: DataFrame) -> DataFrame:
    """token, sig, n, and pivot and m (signature and size of the block's smallest node) of blocks of two nodes and more.

    Rows of rare shingles are dealt and sorted by (shingle, signature) once and streamed: the first row of a block is its
    pivot, copies follow each other, and blocks of one node vanish. Common shingles, which copies of one text or a shared
    passage may have in a third of all rows, are counted with partial sums and joined, so that their blocks can be split."""
    row = lambda c: digests.select(F.explode(c).alias("token"), "sig", "n")
    n = int(digests.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def make():
        stream = BlockStream()
        return lambda batch: iter([stream.take(*(c.to_numpy() for c in batch.columns))])

    rare = map_batches(row("rare").repartition(n, "token").sortWithinPartitions("token", "sig"), ["token", "sig", "n"], "token long, sig long, n long, pivot long, m long", make)
    common = row("common").distinct()
    counted = common.groupBy("token").agg(F.count("*").alias("k"), F.min(F.struct("sig", "n")).alias("p")).where("k > 1").select("token", F.col("p.sig").alias("pivot"), F.col("p.n").alias("m"))
    return rare.unionByName(common.join(counted, "token").select("token", "sig", "n", "pivot", "m"))


def _pivot_pairs(blocks: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of each node with the first node of its block, that sizes and bitmaps allow."""
    close = (F.least("n", "m") * 100 >= percent * F.greatest("n", "m")) & (F.col("sig") != F.col("pivot"))
    pairs = blocks.where(close).select(F.col("pivot").alias("a"), F.col("sig").alias("b")).distinct()
    maps = lambda k, x: nodes.select(F.col("sig").alias(k), F.col("n").alias(f"n{x}"), F.col("map").alias(f"m{x}"))
    both = pairs.join(maps("b", 1), "b").join(maps("a", 0), "a")

    def make():
        def work(batch):
            a, b, n0, n1, m0, m1 = (c.to_pylist() for c in batch.columns)
            ok = [k for k in range(len(a)) if possible(n0[k], m0[k], n1[k], m1[k], percent)]
            yield [[a[k] for k in ok], [b[k] for k in ok]]

        return work

    return map_batches(both, ["a", "b", "n0", "n1", "m0", "m1"], "a long, b long", make)


def _cluster_parts(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """pivot, sig, n, component, part, i and j: the nodes of clusters of several components, once for each pair of parts (i, j)
    in which a node meets others.

    Nodes of small components (in this cluster) are dealt to parts together, those of a larger component to parts of its
    own, which are paired with all other parts but those of the same component."""
    rows = cut(blocks.select("pivot", "sig", "n").distinct().join(labels, "sig", "left").withColumn("component", F.coalesce("component", "sig")))
    parts = lambda c, n: F.ceil(F.greatest(c / BLOCK, n / BLOCK_SHINGLES)).cast("int")
    is_large = (F.col("c") >= BLOCK) | (F.col("n") >= BLOCK_SHINGLES)
    large = F.when(is_large, F.struct("component", parts(F.col("c"), F.col("n")).alias("parts")))
    rest = lambda x: F.sum(F.when(is_large, 0).otherwise(F.col(x)))
    clusters = (
        rows.groupBy("pivot", "component").agg(F.count("*").alias("c"), F.sum("n").alias("n")).groupBy("pivot")
        .agg(F.count("*").alias("components"), F.sum("c").alias("size"), parts(rest("c"), rest("n")).alias("small"), F.collect_list(large).alias("large"))
        .where("components > 1 and size > 2").select("pivot", "small", "large")
    )
    salted = clusters.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("sig"), F.lit(SALTS))).join(salted, ["pivot", "salt"])
    total = lambda x: F.aggregate(x, F.lit(0), lambda n, y: n + y["parts"])
    own = total(F.filter("large", lambda x: x["component"] == F.col("component")))
    first = F.when(own == 0, 0).otherwise(F.col("small") + total(F.filter("large", lambda x: x["component"] < F.col("component"))))
    rows = rows.withColumn("own", own).withColumn("first", first).withColumn("all", F.col("small") + total(F.col("large")))
    rows = rows.withColumn("part", F.col("first") + F.pmod(F.xxhash64("sig", F.lit(1)), F.when(F.col("own") > 0, F.col("own")).otherwise(F.col("small")).cast("long")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("all") - 1), lambda q: (q < F.col("first")) | (q >= F.col("first") + F.col("own")))
    pair = F.transform(others, lambda q: F.struct(F.least(q, F.col("part")).alias("i"), F.greatest(q, F.col("part")).alias("j")))
    kept = ["pivot", "sig", "n", "component", "part"]
    return rows.select(*kept, F.explode(pair).alias("p")).select(*kept, "p.i", "p.j")


def _tree_links(blocks: DataFrame, nodes: DataFrame, labels: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links that join different components of a cluster, by dual walks of signature trees: over small bitmaps for the nodes
    that may have one, then over their whole sets.

    Blocks with the same pivot are one cluster, so that a node's bitmap goes to each of its clusters once and not to each of
    its blocks."""

    def near(key, sigs, sizes, maps, components, parts):
        sigs, components, parts = (np.array(x, np.int64) for x in (sigs, components, parts))
        found: set = set()
        for pair in block_pairs(np.arange(len(sigs)), np.array(sizes, np.int64), maps, components, parts, key[1], key[2], percent):
            found.update(pair)
        at = np.array(sorted(found), np.int64)
        return [np.full(len(at), k, np.int64) for k in key] + [sigs[at], components[at], parts[at]]

    def joining(key, sigs, components, parts, sets):
        sigs, components, parts = (np.array(x, np.int64) for x in (sigs, components, parts))
        up: dict[int, int] = {}

        def top(c: int) -> int:
            while c in up:
                c = up[c]
            return c

        out: list[tuple[int, int]] = []
        sets = [x.astype(np.uint64) for x in sets]
        maps = [bitmap(x, WIDE) for x in sets]
        for i, j in block_pairs(np.arange(len(sigs)), np.array(list(map(len, sets)), np.int64), maps, components, parts, key[1], key[2], percent):
            a, b = top(int(components[i])), top(int(components[j]))
            if a != b:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    up[max(a, b)] = min(a, b)
                    out.append((int(sigs[i]), int(sigs[j])))
        return [[p[0] for p in out], [p[1] for p in out]]

    key = ["pivot", "i", "j"]
    rows = _cluster_parts(blocks, labels).join(nodes.select("sig", "map"), "sig")
    found = cut(_map_blocks(rows, key, ["sig", "n", "map", "component", "part"], "pivot long, i long, j long, sig long, component long, part long", near))
    wanted = cut(found.select("sig").distinct().join(nodes.select("sig", "text_hash"), "sig"))
    rows = found.join(_sets(docs, wanted, width), "sig")
    return _map_blocks(rows, key, ["sig", "component", "part", "shingles"], "a long, b long", joining)


def _map_blocks(df: DataFrame, key: list, columns: list, ddl: str, solve) -> DataFrame:
    """solve(key, *lists of columns), which returns columns of ddl, for all rows of each key. Rows are dealt and sorted by the
    key; those of one key at a time are held."""
    import pyarrow as pa

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def values(c):
        if not pa.types.is_list(c.type):
            return c.to_pylist()
        ends, flat = c.offsets.to_numpy(), c.values.to_numpy()
        return [flat[a:b].copy() for a, b in zip(ends, ends[1:], strict=False)]

    def make():
        held: list = []  # key and rows of the block that the last batch ended in

        def work(batch):
            done = []
            if batch is None:
                done, held[:] = held[:], []
            else:
                lists = list(map(values, batch.columns))
                for row in zip(*lists, strict=True):
                    k = row[: len(key)]
                    if not held or held[0][0] != k:
                        done += held
                        held[:] = [(k, [])]
                    held[0][1].append(row[len(key) :])
            for k, block in done:
                yield solve(k, *map(list, zip(*block, strict=True)))

        return work

    rows = df.select(*key, *columns).repartition(n, *key).sortWithinPartitions(*key)
    return map_batches(rows, [*key, *columns], ddl, make, ended=True)


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach) and n_copies (rows of the same set)."""
    docs = docs.select("doc_id", "text")
    digests = cut(_digests(docs, width, percent))
    full = digests.where("n > 0")
    nodes = cut(full.groupBy("sig").agg(F.first("n").alias("n"), F.first("map").alias("map"), F.first("text_hash").alias("text_hash"), F.min("doc_id").alias("first"), F.count("*").alias("copies")))
    blocks = cut(_blocks(full))
    # beside the smallest node, another one, which differs from block to block, joins most of a group of near copies
    other = blocks.groupBy("token").agg(F.count("*").alias("k"), F.min(F.struct(F.xxhash64("sig", "token").alias("h"), "sig", "n")).alias("p")).where("k > 2").select("token", "p")
    more = blocks.join(other, "token").select("sig", "n", F.col("p.sig").alias("pivot"), F.col("p.n").alias("m"))
    links = cut(_verified(cut(_pivot_pairs(blocks.select("sig", "n", "pivot", "m").unionByName(more), nodes, percent)), docs, nodes, width, percent))
    labels = cut(components(links))
    found = labels.select(F.col("sig").alias("a"), F.col("component").alias("b"))
    labels = components(found.unionByName(_tree_links(blocks, nodes, labels, docs, width, percent)))
    linked = nodes.select("sig", "first", "copies").join(labels, "sig")
    names = linked.groupBy("component").agg(F.min("first").alias("name"))
    by_sig = linked.join(names, "component").select("sig", "name", "copies")
    alone = nodes.where("copies > 1").join(labels, "sig", "left_anti").select("sig", F.col("first").alias("name"), "copies")
    salted = by_sig.unionByName(alone).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    rows = digests.select("doc_id", F.col("n").alias("n_shingles"), "sig").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    return rows.join(salted, ["sig", "salt"], "left").select("doc_id", "n_shingles", F.coalesce("name", "doc_id").alias("component_id"), F.when(F.col("n_shingles") > 0, F.coalesce("copies", F.lit(1))).otherwise(1).alias("n_copies"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
