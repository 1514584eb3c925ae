"""Sources and truth, with their invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class InvariantError(ValueError):
    """A table breaks a rule that later stages rely on."""


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise InvariantError(message)


def check_unique(df: DataFrame, column: str, name: str = "table") -> None:
    _require(not df.groupBy(column).count().where("count > 1").head(1), f"{name}: duplicate {column}")


def check_same_ids(a: DataFrame, b: DataFrame, message: str) -> None:
    """Both hold the same set of values in their single column."""
    b = b.toDF(a.columns[0])
    _require(not a.join(b, a.columns[0], "left_anti").head(1) and not b.join(a, a.columns[0], "left_anti").head(1), message)


def check_rows(df: DataFrame, expected: int | None, name: str) -> int:
    n = df.count()
    _require(expected is None or n == expected, f"{name}: {n} rows, expected {expected}")
    return n


def source_table(raw: DataFrame, source: int, expected: int | None = None) -> DataFrame:
    """A source's records with its number; ids are unique."""
    check_rows(raw, expected, f"source {source}")
    check_unique(raw, "entity_id", f"source {source}")
    return raw.withColumn("source", F.lit(source).cast("byte"))


def truth_pairs(truth: DataFrame) -> DataFrame:
    """(s1_id, other_id) of lists joined by commas; empty fields vanish."""
    return truth.select(F.col("source1_entity_id").alias("s1_id"), F.explode(F.split("matched_entity_ids", ",")).alias("other_id")).where("other_id <> ''")


def truth_counts(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """(s1_id, n_matches) of every listed id."""
    n = pairs.groupBy("s1_id").agg(F.count("*").alias("n"))
    return truth.select(F.col("source1_entity_id").alias("s1_id")).join(n, "s1_id", "left").select("s1_id", F.coalesce("n", F.lit(0)).cast("short").alias("n_matches"))


def check_truth(truth: DataFrame, s1: DataFrame, pairs: DataFrame) -> None:
    check_unique(truth, "source1_entity_id", "truth")
    check_same_ids(truth.select("source1_entity_id"), s1.select("entity_id"), "the truth's ids are not those of source 1")
    check_unique(pairs, "other_id", "truth pairs")
    _require(not pairs.where(~F.col("other_id").rlike("^S[23]-")).head(1), "the truth holds an id of another source")


def truth_report(pairs: DataFrame, counts: DataFrame) -> dict:
    by = pairs.agg(F.count("*").alias("n"), *(F.count_if(F.col("other_id").startswith(f"S{k}-")).alias(f"s{k}") for k in (2, 3))).first()
    hist = {r.n_matches: r["count"] for r in counts.groupBy("n_matches").count().orderBy("n_matches").collect()}
    total = sum(hist.values())
    return {
        "n_gt_pairs": by.n, "n_gt_pairs_s2": by.s2, "n_gt_pairs_s3": by.s3, "n_singletons": hist.get(0, 0),
        "singleton_rate": round(hist.get(0, 0) / total, 6) if total else None, "mean_matches_per_s1": round(by.n / total, 4) if total else None, "matches_per_s1_hist": hist,
    }
