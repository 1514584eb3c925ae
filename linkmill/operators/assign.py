"""One-to-one assignment and matchers by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def one_to_one(df: DataFrame, score: str = "prob") -> DataFrame:
    """Each other record stays with the s1 of the highest score; ties go to the smallest s1_id."""
    w = Window.partitionBy("other_id").orderBy(F.desc(score), "s1_id")
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def baseline(cand: DataFrame) -> DataFrame:
    """(s1_id, other_id, prob): cheap scores as probabilities, assigned one to one."""
    return one_to_one(cand.select("s1_id", "other_id", F.round("cheap_score", 6).alias("prob")))


def kept(pred: DataFrame, threshold: float) -> DataFrame:
    """All rows, with the flag of those at or above the threshold."""
    return pred.withColumn("kept", F.col("prob") >= F.lit(threshold))


def capped_matches(pred: DataFrame, thresholds: dict[str, float], most: int | None = None, top_gate: float | None = None) -> DataFrame:
    """Matches by a threshold for each source prefix, at most `most` for each s1, only where the s1's best reaches top_gate."""
    limit = F.coalesce(*(F.when(F.col("other_id").startswith(p), F.lit(t)) for p, t in thresholds.items()), F.lit(1.0))
    w = Window.partitionBy("s1_id")
    df = pred.withColumn("__top", F.max("prob").over(w)).where(F.col("prob") >= limit)
    df = df if top_gate is None else df.where(F.col("__top") >= top_gate)
    df = df.drop("__top")
    if most is None:
        return df
    return df.withColumn("__rank", F.row_number().over(w.orderBy(F.desc("prob"), "other_id"))).where(F.col("__rank") <= most).drop("__rank")
