"""Region aliases, learned from how true pairs write the ends of their addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkmill.functions import text as T
from linkmill.functions import vocab
from linkmill.operators.splits import seeded_sample


def sample_pairs(truth: DataFrame, records: DataFrame, n: int = vocab.ALIAS_SAMPLE) -> DataFrame:
    """country and both addresses of n seeded true pairs (all, if there are fewer)."""
    side = lambda id_, c: records.select(F.col("entity_id").alias(id_), F.col("business_address").alias(c))
    some = seeded_sample(truth.select("s1_id", "other_id"), n, "s1_id", "other_id")
    country = records.select(F.col("entity_id").alias("s1_id"), "country")
    return some.join(side("s1_id", "addr_s1"), "s1_id").join(side("other_id", "addr_other"), "other_id").join(country, "s1_id").select("country", "addr_s1", "addr_other")


def counts(pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(place, s1_last, s1_any) of source 1, (place, other_last, occ) of the other side, and (variant, canonical, country, n)
    of places that stand together but not on the source 1 side."""
    last = lambda a: F.when(F.size(a) > 0, F.get(a, F.size(a) - 1))
    p = pairs.select("country", T.tail_parts("addr_s1").alias("t1"), T.tail_parts("addr_other").alias("t2"))
    side = lambda t, a, b: p.select(F.explode(F.array_distinct(t)).alias("place"), last(F.col(t)).alias("l")).groupBy("place").agg(F.count_if(F.col("place") == F.col("l")).alias(a), F.count("*").alias(b))
    new = F.array_except("t2", "t1")
    together = p.select("country", F.explode(new).alias("variant"), "t1").select("country", "variant", F.explode(F.array_distinct("t1")).alias("canonical"))
    return side("t1", "s1_last", "s1_any"), side("t2", "other_last", "occ"), together.groupBy("variant", "canonical", "country").agg(F.count("*").alias("n"))


def learn(pairs: DataFrame, min_count: int = vocab.ALIAS_MIN_COUNT, min_share: float = vocab.ALIAS_MIN_SHARE, last_share: float = vocab.ALIAS_LAST_SHARE) -> DataFrame:
    """variant, canonical, count, occurrences, country; a canonical is a variant of itself.

    Canonical: often the last part on the source 1 side, and nearly always so where it stands. City: often there, but not
    so. A variant is neither, is nearly always last on the other side, and stands beside its canonical nearly always."""
    s1, other, together = counts(pairs)
    often = F.col("s1_any") >= min_count
    is_last = F.col("s1_last") / F.col("s1_any") >= last_share
    canon = s1.where((F.col("s1_last") >= min_count) & is_last).select(F.col("place").alias("canonical"), F.col("s1_last").alias("count"))
    city = s1.where(often & ~is_last).select(F.col("place").alias("variant"))
    total = together.groupBy("variant", "canonical").agg(F.sum("n").alias("count"), F.max_by("country", F.struct("n", "country")).alias("country"))
    other = other.select(F.col("place").alias("variant"), "other_last", F.col("occ").alias("occurrences"))
    found = (
        total.join(canon.select("canonical"), "canonical", "left_semi").join(canon.select(F.col("canonical").alias("variant")), "variant", "left_anti")
        .join(city, "variant", "left_anti").join(other, "variant")
        .where((F.col("other_last") / F.col("occurrences") >= last_share) & (F.col("count") >= min_count) & (F.col("count") >= min_share * F.col("occurrences")))
    )
    best = found.withColumn("__rank", F.row_number().over(Window.partitionBy("variant").orderBy(F.desc("count"), "canonical"))).where("__rank = 1")
    itself = canon.select(F.col("canonical").alias("variant"), "canonical", "count", F.col("count").alias("occurrences"), F.lit("").alias("country"))
    return best.select("variant", "canonical", "count", "occurrences", "country").unionByName(itself)


def as_dict(learned: DataFrame) -> dict[str, str]:
    """The table for the normal forms: as small as the number of regions."""
    return {r.variant: r.canonical for r in learned.select("variant", "canonical").orderBy("variant").collect()}


def sanity(learned: DataFrame, expected: tuple = vocab.EXPECTED_ALIASES) -> DataFrame:
    """variant, canonical, learned (what it maps to, or null), ok."""
    want = learned.sparkSession.createDataFrame(list(expected), "variant string, canonical string")
    got = learned.select("variant", F.col("canonical").alias("learned"))
    return F.broadcast(want).join(got, "variant", "left").select("variant", "canonical", "learned", F.coalesce((F.col("learned") == F.col("canonical")) & (F.col("variant") != F.col("canonical")), F.lit(False)).alias("ok"))
