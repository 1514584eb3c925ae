"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Presence of each character n-gram (hashed to a fixed number of buckets) is multiplied by the log ratio of its smoothed
document counts in the two classes; a logistic regression is fitted on these scaled features. Which ratios are clear enough
for a feature is decided on a part of the training rows. Scoring is one pass over
the text in numpy, without a shuffle; the weights are one array of a fixed size.

Nulls and empty texts have no n-grams and get the score of the bias alone. Repeated rows get equal scores. Texts of any
length are read whole, in overlapping slices. An empty table gives an empty result; with no usable labels, or labels of
one class only, every score is the smoothed rate of label 1. Other columns of the input are not read, so their names
cannot clash.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm._base import cut, held_out, labelled_sample, map_batches, slices, table

ORDERS = (3, 4, 5, 6)
BITS = 20
#: Bound on the labelled rows that the classifier is fitted on.
TRAIN_ROWS = 8000
#: Tasks that count and list the n-grams of these rows, and the most n-grams that may become features.
TASKS, FEATURES = 8, 1 << 16
#: Least size of a log-count ratio in its standard errors, for a feature. The choice is made inside the training rows.
MIN_Z = (3.0, 3.5, 5.0)
ROUNDS, INNER_ROUNDS, SCALE = 200, 80, 0.1
THRESHOLD = 0.3
SLICE = 1 << 20


def buckets(text: str | None) -> "list[np.ndarray]":
    """Hashed bucket of every character n-gram of the lower-cased text, a slice at a time."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    out = []
    for part in slices(codes, SLICE, max(ORDERS) - 1):
        h = part
        for n in range(2, max(ORDERS) + 1):
            if len(part) < n:
                break
            h = h[:-1] * np.uint32(0x01000193) + part[n - 1 :]
            if n in ORDERS:
                out.append(((h ^ np.uint32(n)) * np.uint32(2654435769)) >> np.uint32(32 - BITS))
    return out


def present(text: str | None, seen: np.ndarray) -> np.ndarray:
    """Distinct buckets; `seen` is scratch space and is left clean."""
    parts = buckets(text)
    for p in parts:
        seen[p] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def ratios(count: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log ratio of smoothed document counts, its size in standard errors) of each bucket. count: class x bucket; rows: rows
    of each class."""
    p, q = (count[1] + 1) / (rows[1] + 2), (count[0] + 1) / (rows[0] + 2)
    ratio = np.log(p / q)
    return ratio, np.abs(ratio) / np.sqrt(1 / (count[1] + 1) + 1 / (count[0] + 1))


def logistic(columns: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, bias: float, rounds: int, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """(weight of each feature, bias) by full-batch Adam. columns: features present in each row; their value is `ratio`."""
    column, row = np.concatenate(columns), np.repeat(np.arange(len(y)), list(map(len, columns)))
    value, total, size = ratio[column], len(y), len(ratio)
    w, m, v = np.zeros(size), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, rounds + 1):
        margin = np.clip(np.bincount(row, w[column] * value, total) + bias, -30, 30)
        slope = (1 / (1 + np.exp(-margin)) - y) / total
        g = np.append(np.bincount(column, slope[row] * value, size) + l2 * w / max(size, 1), slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, bias


def _prior(rows: np.ndarray) -> float:
    p = (rows[1] + 1) / (rows.sum() + 2)
    return float(np.log(p / (1 - p)))


def fit(count: np.ndarray, rows: np.ndarray, columns: list[np.ndarray], buckets_: np.ndarray, y: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, float]:
    """(weight of each bucket, bias). count: fold x class x bucket; rows: fold x class; columns: places in `buckets_` of each
    row's buckets. Fold 1 chooses the cut-off among MIN_Z for a model of fold 0; the model is then fitted on both."""

    def solve(own: np.ndarray, c: np.ndarray, r: np.ndarray, min_z: float, rounds: int):
        ratio, z = ratios(c[:, buckets_], r)
        chosen = z >= min_z
        place = np.cumsum(chosen) - 1
        lists = [place[x[chosen[x]]] for x in own_rows(columns, own)]
        w, bias = logistic(lists, ratio[chosen] * SCALE, y[own], _prior(r), rounds)
        weight = np.zeros(len(buckets_))
        weight[chosen] = w * ratio[chosen] * SCALE
        return weight, bias

    def own_rows(lists, at):
        return [lists[i] for i in at]

    inner, outer = np.flatnonzero(fold == 0), np.flatnonzero(fold == 1)
    best = MIN_Z[0]
    if len(outer) and rows[0].min() > 0:
        losses = []
        for min_z in MIN_Z:
            weight, bias = solve(inner, count[0], rows[0], min_z, INNER_ROUNDS)
            margin = np.clip([weight[columns[i]].sum() + bias for i in outer], -30, 30)
            losses.append((float(np.mean(np.log1p(np.exp(margin)) - y[outer] * margin)), -min_z))
        best = -min(losses)[1]
    weight, bias = solve(np.arange(len(y)), count.sum(0), rows.sum(0), best, ROUNDS)
    weights = np.zeros(1 << BITS, np.float32)
    weights[buckets_] = weight
    return weights, float(bias)


def score_texts(texts: list, weights: np.ndarray, bias: float, seen: np.ndarray) -> np.ndarray:
    margin = np.array([float(weights[present(t, seen)].sum(dtype=np.float64)) + bias for t in texts], np.float64)
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(fold x class x bucket, fold x class): rows of a sample (text, y, fold) that hold each bucket, and all rows. A task sends
    its counts packed, as one row."""

    def make():
        count, rows, seen = np.zeros((2, 2, 1 << BITS), np.uint16), np.zeros((2, 2), np.int64), np.zeros(1 << BITS, bool)

        def work(batch):
            if batch is None:
                if rows.any():
                    yield [[rows.ravel().tolist()], [zlib.compress(count.tobytes(), 1)]]
                return
            texts, ys, folds = (c.to_pylist() for c in batch.columns)
            for text, y, fold in zip(texts, ys, folds, strict=True):
                count[fold, y, present(text, seen)] += 1
                rows[fold, y] += 1

        return work

    total, rows = np.zeros((2, 2, 1 << BITS), np.int32), np.zeros((2, 2), np.int64)
    for r in map_batches(sample, ["text", "y", "fold"], "rows array<long>, count binary", make, ended=True).toLocalIterator():
        total += np.frombuffer(zlib.decompress(r["count"]), np.uint16).reshape(total.shape)
        rows += np.array(r["rows"]).reshape(2, 2)
    return total, rows


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, modulus: int = 4, remainder: int = 2) -> tuple[np.ndarray, float]:
    """The model, from a sample of labelled rows bounded by `rows`. n-grams are counted, then listed, on the executors; the
    driver gets TASKS packed tables of counts and, for each row, those of its buckets that may become features, FEATURES at
    most. Equal texts are in the same fold."""
    fold = (F.pmod(F.xxhash64("text"), F.lit(4)) == 0).cast("int").alias("fold")
    # the bound on rows keeps counts of a task within 16 bits
    sample = cut(labelled_sample(docs, labels, "toxic", modulus, remainder, rows).select("text", "y", fold).repartition(TASKS))
    count, total = counts(sample)
    classes = total.sum(0)
    if not classes.min():
        return np.zeros(1 << BITS, np.float32), _prior(classes)
    z = np.maximum(ratios(count.sum(0), classes)[1], ratios(count[0], total[0])[1])
    usable = np.flatnonzero(z >= min(MIN_Z))
    usable = np.sort(usable[np.argsort(-z[usable], kind="stable")[:FEATURES]])
    shared = docs.sparkSession.sparkContext.broadcast(usable.astype(np.int32))

    def make():
        place, seen = np.full(1 << BITS, -1, np.int32), np.zeros(1 << BITS, bool)
        place[shared.value] = np.arange(len(shared.value), dtype=np.int32)

        def work(batch):
            found = [place[present(t, seen)] for t in batch.column(0).to_pylist()]
            yield [batch.column(1), batch.column(2), [x[x >= 0].tobytes() for x in found]]

        return work

    listed = sorted((r.y, r.fold, bytes(r.found)) for r in map_batches(sample, ["text", "y", "fold"], "y int, fold int, found binary", make).collect())
    columns = [np.frombuffer(x[2], np.int32) for x in listed]
    return fit(count, total, columns, usable, np.array([x[0] for x in listed], np.float64), np.array([x[1] for x in listed]))


def toxicity_scores(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed 4 MB

    def make():
        weights, bias = shared.value
        seen = np.zeros(1 << BITS, bool)

        def work(batch):
            s = score_texts(batch.column(1).to_pylist(), weights, bias, seen)
            yield [batch.column(0), s, (s >= threshold).astype(np.int32)]

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, ["doc_id", "text"], f"doc_id {kind}, score double, predicted int", make)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity_scores(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), F.col("score"), F.col("predicted"))
