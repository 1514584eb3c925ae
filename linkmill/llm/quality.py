"""Quality classifier: a generalised additive model with pairwise interactions.

Shape and repetition features of a text are binned at quantiles. Cyclic boosting visits one feature after another and adds
a shallow tree (at most four leaves over its bins) to that feature's lookup table; the strongest pairs, ranked by what a
four-quadrant cut gains on the residuals, are then boosted likewise over two-dimensional tables. A score is the sum of
one entry of each table, looked up for all rows of a batch at once.

Only features of at most TRAIN_ROWS labelled rows reach the driver; scoring is one pass without a shuffle. Nulls and
empty texts have features of zeros, so they are scored as such. Repeated rows get equal scores; texts of any length are
read whole. An empty table gives an empty result; with no usable labels, or labels of one class, every score is the
smoothed rate of label 1. Other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm._base import held_out, labelled_sample, map_batches, small_batches, table

#: Bound on the labelled rows that the model is fitted on.
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
BINS, PAIR_BINS, PAIRS = 32, 8, 8
FEATURES = (
    "log_chars", "upper", "symbol", "bar", "bang", "digit", "space", "stop", "other_mark", "word_chars", "longest_word", "short_words",
    "distinct_words", "top_word", "repeated_next", "distinct_pairs", "distinct_lines", "line_words", "code_entropy", "capital_words",
)

# Class of each ASCII code: 0 none, 1 upper, 2 lower, 3 digit, 4 space, 5 "|", 6 "!", 7 ".", 8 #$%&*@^~<>{}[]=+\_, 9 other marks.
KIND = np.zeros(128, np.uint8)
KIND[33:127] = 9
KIND[65:91], KIND[97:123], KIND[48:58] = 1, 2, 3
for _i, _marks in ((4, " \t\n\r\v\f"), (5, "|"), (6, "!"), (7, "."), (8, "#$%&*@^~<>{}[]=+\\_")):
    KIND[[ord(x) for x in _marks]] = _i


def features(text: str | None) -> list[float]:
    """One value for each of FEATURES; zeros for a text without words."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    n, w = len(text), len(words)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    ascii_ = raw[raw < 128]
    codes = np.bincount(ascii_, minlength=128)
    kinds = np.bincount(KIND, weights=codes, minlength=10)
    letters = max(kinds[1] + kinds[2] + n - len(ascii_), 1)
    sizes = np.fromiter(map(len, words), np.int64, w)
    seen: dict[str, int] = {}
    for x in words:
        seen[x] = seen.get(x, 0) + 1
    after = words[1:]
    lines = text.split("\n")
    share = codes[codes > 0] / max(len(ascii_), 1)
    return [
        float(np.log1p(n)), kinds[1] / letters, kinds[8] / n, kinds[5] / n, kinds[6] / n, kinds[3] / n, kinds[4] / n, kinds[7] / w, kinds[9] / n,
        float(sizes.mean()), float(sizes.max()), float((sizes <= 3).mean()), len(seen) / w, max(seen.values()) / w,
        sum(map(str.__eq__, words, after)) / w, len(set(zip(words, after, strict=False))) / max(w - 1, 1), len(set(lines)) / len(lines), w / len(lines),
        float(-(share * np.log2(share)).sum()), sum(map(str.isupper, words)) / w,
    ]


@dataclass
class Model:
    cuts: list  # quantile cuts of each feature
    single: np.ndarray  # feature x bin
    coarse: np.ndarray  # feature x bin: the coarser bin that pairs use
    pairs: list  # (feature, feature, table)
    bias: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, i], "right") for i, c in enumerate(self.cuts)], 1) if len(x) else np.zeros((0, len(self.cuts)), np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        margin = np.full(len(x), self.bias)
        for i in range(len(self.cuts)):
            margin += self.single[i, b[:, i]]
        for i, j, t in self.pairs:
            margin += t[self.coarse[i, b[:, i]], self.coarse[j, b[:, j]]]
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _leaf(g, h):
    return g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Value of each bin by a tree of depth two over the order of the bins; g: sums of residuals, h: of their weights."""
    gain = lambda g, h: g * g / (h + 1.0)
    out = np.empty(len(g))

    def cut(lo: int, hi: int, depth: int) -> None:
        cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
        if depth and hi - lo > 1:
            gains = gain(cg[:-1], ch[:-1]) + gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1])
            k = int(np.argmax(gains))
            if gains[k] > gain(cg[-1], ch[-1]) + 1e-9:
                cut(lo, lo + k + 1, depth - 1)
                cut(lo + k + 1, hi, depth - 1)
                return
        out[lo:hi] = _leaf(cg[-1], ch[-1])

    cut(0, len(g), 2)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best cut of a grid into four quadrants: its gain, and the value of each cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts = []
    for c in (cg, ch):
        a = c[:-1, :-1]
        right, down, all_ = c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        parts.append(np.stack([a, right - a, down - a, all_ - right - down + a]))
    gains = (parts[0] ** 2 / (parts[1] + 1.0)).sum(0)
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    v = _leaf(parts[0][:, i, j], parts[1][:, i, j])
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
    return float(gains[i, j] - cg[-1, -1] ** 2 / (ch[-1, -1] + 1.0)), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, rate: float = 0.1) -> Model:
    n, f = len(y), len(FEATURES)
    prior = (y.sum() + 1) / (n + 2)
    model = Model([np.zeros(0)] * f, np.zeros((f, BINS)), np.zeros((f, BINS), np.int64), [], float(np.log(prior / (1 - prior))))
    if not 0 < y.sum() < n:
        return model
    model.cuts = [np.unique(np.quantile(x[:, i], np.arange(1, BINS) / BINS)) for i in range(f)]
    b = model.bins(x)
    for i in range(f):  # neighbouring bins are joined until PAIR_BINS are left
        model.coarse[i] = np.minimum(np.arange(BINS) * PAIR_BINS // max(len(model.cuts[i]) + 1, PAIR_BINS), PAIR_BINS - 1)
    margin = np.full(n, model.bias)

    def residual():
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for i in range(f):
            g, h = residual()
            t = rate * _tree(np.bincount(b[:, i], g, BINS), np.bincount(b[:, i], h, BINS))
            model.single[i] += t
            margin += t[b[:, i]]
    c = np.stack([model.coarse[i, b[:, i]] for i in range(f)], 1)
    grid = lambda i, j, v: np.bincount(c[:, i] * PAIR_BINS + c[:, j], v, PAIR_BINS**2).reshape(PAIR_BINS, -1)
    g, h = residual()
    ranked = sorted(((-_quadrants(grid(i, j, g), grid(i, j, h))[0], i, j) for i, j in combinations(range(f), 2)))
    model.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in ranked[:PAIRS]]
    for _ in range(pair_rounds):
        for i, j, t in model.pairs:
            g, h = residual()
            _, v = _quadrants(grid(i, j, g), grid(i, j, h))
            t += rate * v
            margin += rate * v[c[:, i], c[:, j]]
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, modulus: int = 5, remainder: int = 0) -> Model:
    """Features of the sampled labelled rows are computed on the executors; their values alone come to the driver."""

    def make():
        return lambda batch: iter([[[features(t) for t in batch.column(0).to_pylist()], batch.column(1)]])

    sample = labelled_sample(docs, labels, "quality", modulus, remainder, rows)
    got = map_batches(sample, ["text", "y"], "x array<double>, y int", make).collect()
    got = sorted((r.x, r.y) for r in got)
    return fit(np.array([r[0] for r in got], np.float64).reshape(-1, len(FEATURES)), np.array([r[1] for r in got], np.float64))


def quality_scores(docs: DataFrame, model: Model, keep: tuple = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """The kept columns, score and predicted for every row of docs. Kept columns may not be named score or predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some tables of fixed size
    at = len(keep)

    def make():
        model = shared.value

        def work(batch):
            x = np.array([features(t) for t in batch.column(at).to_pylist()], np.float64).reshape(-1, len(FEATURES))
            s = model.score(x)
            yield [*batch.columns[:at], s, (s >= threshold).astype(np.int32)]

        return work

    ddl = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_batches(docs, [*(F.col(f"`{c}`") for c in keep), F.col("text").alias("__text")], f"{ddl}, score double, predicted int", make)


def score_column(docs: DataFrame, model: Model, text: str = "text"):
    """The score as a column of docs; the other columns don't leave the JVM."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(np.array([features(t) for t in texts], np.float64).reshape(-1, len(FEATURES))))

    return F.pandas_udf(run, "double")(F.col(text))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality_scores(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), F.col("score"), F.col("predicted"))
