"""Precision-weighted macro F0.5, threshold curve, candidate statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkmill.functions import vocab


def f05(tp: Column, n_pred: Column, n_true: Column) -> Column:
    """F0.5 of one entity. Without truth: 1 if nothing is predicted, else 0; without a hit: 0."""
    p, r = tp / F.when(n_pred > 0, n_pred).otherwise(1), tp / F.when(n_true > 0, n_true).otherwise(1)
    return F.when(n_true == 0, F.when(n_pred == 0, 1.0).otherwise(0.0)).when(tp == 0, 0.0).otherwise(1.25 * p * r / F.when(0.25 * p + r > 0, 0.25 * p + r).otherwise(1))


def per_entity(pred: DataFrame, truth: DataFrame, ids: DataFrame) -> DataFrame:
    """ids with tp, n_pred, n_true and f05; every id appears, also without predictions. Repeated pairs count once."""
    pred, truth = pred.select("s1_id", "other_id").distinct(), truth.select("s1_id", "other_id").distinct()
    both = pred.withColumn("p", F.lit(1)).join(truth.withColumn("t", F.lit(1)), ["s1_id", "other_id"], "full")
    n = both.groupBy("s1_id").agg(F.count(F.when(F.col("p").isNotNull() & F.col("t").isNotNull(), 1)).alias("tp"), F.count("p").alias("n_pred"), F.count("t").alias("n_true"))
    out = ids.join(n, "s1_id", "left").na.fill(0, ["tp", "n_pred", "n_true"])
    return out.withColumn("f05", f05(F.col("tp"), F.col("n_pred"), F.col("n_true")))


def macro_f05(pred: DataFrame, truth: DataFrame, ids: DataFrame) -> DataFrame:
    """One row; null without ids."""
    return per_entity(pred, truth, ids).agg(F.round(F.avg("f05"), 6).alias("macro_f05"))


def prediction_report(pred: DataFrame, threshold: float, truth: DataFrame, ids: DataFrame) -> DataFrame:
    """One row: threshold, n_s1, macro F0.5 (all, singletons, others), micro precision and recall, predicted pairs."""
    e = per_entity(pred.where(F.col("prob") >= threshold).join(ids, "s1_id", "left_semi"), truth.join(ids, "s1_id", "left_semi"), ids)
    return e.agg(
        F.lit(round(threshold, 6)).alias("threshold"), F.count("*").alias("n_s1"), F.round(F.avg("f05"), 6).alias("macro_f05"),
        F.round(F.try_divide(F.sum("tp"), F.sum("n_pred")), 6).alias("precision"), F.round(F.try_divide(F.sum("tp"), F.sum("n_true")), 6).alias("recall"),
        F.round(F.avg(F.when(F.col("n_true") == 0, F.col("f05"))), 6).alias("macro_f05_singletons"),
        F.round(F.avg(F.when(F.col("n_true") > 0, F.col("f05"))), 6).alias("macro_f05_non_singletons"), F.sum("n_pred").alias("n_pred_pairs"),
    )


def f05_by_country(pred: DataFrame, truth: DataFrame, ids: DataFrame) -> DataFrame:
    """Mean F0.5 by the ids' country."""
    return per_entity(pred, truth, ids).groupBy("country").agg(F.round(F.avg("f05"), 6).alias("macro_f05"))


def threshold_curve(pred: DataFrame, truth: DataFrame, ids: DataFrame, grid: tuple = vocab.THRESHOLDS) -> DataFrame:
    """threshold, macro_f05 for every threshold of the grid.

    Rows fall into buckets by how many thresholds they reach; counts at a threshold are sums of the buckets above it.
    Between two buckets of an entity nothing changes, so only their changes are kept: an entity adds one row for each of
    its buckets, not one for each threshold, and the grid (a fixed number of rows) is met after the sums."""
    inside = pred.join(ids.select("s1_id"), "s1_id", "left_semi").select("s1_id", "other_id", "prob")
    hit = inside.join(truth.select("s1_id", "other_id", F.lit(1).alias("t")), ["s1_id", "other_id"], "left")
    bucket = F.size(F.filter(F.array(*(F.lit(float(g)) for g in grid)), lambda g: g <= F.col("prob")))
    cells = hit.withColumn("b", bucket).where("b > 0").groupBy("s1_id", "b").agg(F.count("*").alias("n"), F.count("t").alias("tp"))
    up = Window.partitionBy("s1_id").orderBy(F.desc("b"))
    above = up.rowsBetween(Window.unboundedPreceding, 0)
    true = truth.join(ids.select("s1_id"), "s1_id", "left_semi").groupBy("s1_id").agg(F.count("*").alias("n_true"))
    sums = cells.withColumn("n_pred", F.sum("n").over(above)).withColumn("tp_all", F.sum("tp").over(above)).withColumn("low", F.coalesce(F.max("b").over(up.rowsBetween(1, 1)), F.lit(0)))
    sums = sums.join(true, "s1_id", "left").na.fill(0, ["n_true"])
    # with nothing kept an entity scores 1 without truth, else 0; from bucket b down to low + 1 it scores f
    gain = f05(F.col("tp_all"), F.col("n_pred"), F.col("n_true")) - F.when(F.col("n_true") == 0, 1.0).otherwise(0.0)
    steps = sums.select("b", "low", gain.alias("gain")).groupBy("b", "low").agg(F.sum("gain").alias("gain"))  # at most grid squared
    base = ids.select("s1_id").join(true, "s1_id", "left").agg(F.count("*").alias("n_s1"), F.count_if(F.col("n_true").isNull()).alias("single"))
    points = ids.sparkSession.createDataFrame([(i + 1, float(g)) for i, g in enumerate(grid)], "i int, threshold double")
    at = points.join(F.broadcast(steps), (F.col("i") <= F.col("b")) & (F.col("i") > F.col("low")), "left").groupBy("threshold").agg(F.coalesce(F.sum("gain"), F.lit(0.0)).alias("gain"))
    return at.join(F.broadcast(base)).select("threshold", F.round(F.try_divide(F.col("gain") + F.col("single"), F.col("n_s1")), 6).alias("macro_f05"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The row of the highest macro F0.5; the lowest threshold wins ties."""
    return curve.orderBy(F.desc("macro_f05"), F.asc("threshold")).limit(1)


def ranked(cand: DataFrame) -> DataFrame:
    w = Window.partitionBy("s1_id").orderBy(F.desc("cheap_score"), "other_id")
    return cand.withColumn("rank", F.row_number().over(w))


def recall(cand: DataFrame, truth: DataFrame, ids: DataFrame, ks: tuple = vocab.RECALL_KS) -> DataFrame:
    """One row: pairs, recall of all candidates, at k, by key family, all over the ids' true pairs."""
    own = ranked(cand.join(ids.select("s1_id"), "s1_id", "left_semi"))
    true = truth.join(ids.select("s1_id"), "s1_id", "left_semi")
    hit = own.join(true.select("s1_id", "other_id", F.lit(1).alias("t")), ["s1_id", "other_id"], "left")
    bit = lambda b: F.col("key_hits").bitwiseAND(b) > 0
    t = F.col("t") == 1
    n = hit.agg(
        F.count("*").alias("n_cand_pairs"), F.count("t").alias("__all"), *(F.count_if(t & (F.col("rank") <= k)).alias(f"__at_{k}") for k in ks),
        *(F.count_if(bit(b)).alias(f"pairs_{k}") for k, b in vocab.KEY_BITS.items()), *(F.count_if(t & bit(b)).alias(f"__{k}") for k, b in vocab.KEY_BITS.items()),
    )
    share = lambda c, name: F.round(F.try_divide(F.col(c), F.col("n_true_pairs")), 6).alias(name)
    both = n.join(F.broadcast(true.agg(F.count("*").alias("n_true_pairs"))))
    return both.select("n_true_pairs", "n_cand_pairs", share("__all", "recall_all"), *(share(f"__at_{k}", f"recall_at_{k}") for k in ks), *(f"pairs_{k}" for k in vocab.KEY_BITS), *(share(f"__{k}", f"recall_{k}") for k in vocab.KEY_BITS))


def recall_by_country(cand: DataFrame, truth: DataFrame, ids: DataFrame) -> DataFrame:
    """country, recall of the true pairs of its ids."""
    hit = truth.join(ids.select("s1_id", "country"), "s1_id").join(cand.select("s1_id", "other_id", F.lit(1).alias("c")), ["s1_id", "other_id"], "left")
    return hit.groupBy("country").agg(F.round(F.count("c") / F.count("*"), 6).alias("recall"))


def pairs_per_s1(cand: DataFrame, ids: DataFrame) -> DataFrame:
    """One row: share of ids without candidates; mean, p50, p95 and max of their number."""
    n = ids.select("s1_id").join(cand.groupBy("s1_id").agg(F.count("*").alias("n")), "s1_id", "left").na.fill(0, ["n"])
    return n.agg(
        F.round(F.avg((F.col("n") == 0).cast("double")), 6).alias("zero_share"), F.round(F.avg("n"), 3).alias("mean"),
        F.percentile("n", 0.5).alias("p50"), F.percentile("n", 0.95).alias("p95"), F.max("n").alias("max"),
    )


def oracle_f05(cand: DataFrame, truth: DataFrame, ids: DataFrame) -> DataFrame:
    """Macro F0.5 if exactly the true candidates were predicted."""
    return macro_f05(cand.select("s1_id", "other_id").join(truth, ["s1_id", "other_id"], "left_semi"), truth, ids).withColumnRenamed("macro_f05", "oracle_macro_f05")
