"""Shards and folds from a stable hash of ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.functions import vocab


def shard_of(entity: Column, shards: int = vocab.N_SHARDS) -> Column:
    return (F.crc32(entity) % shards).cast("short")


def fold_of(entity: Column, modulus: int = vocab.VAL_MOD) -> Column:
    return F.when(F.crc32(F.concat(entity, F.lit("#fold"))) % modulus == 0, "val").otherwise("fit")


def splits(ids: DataFrame, column: str = "entity_id") -> DataFrame:
    c = F.col(column)
    return ids.select(c.alias("s1_id"), fold_of(c).alias("fold"), shard_of(c).alias("shard"))


def split_report(assigned: DataFrame, gt_s1: DataFrame) -> dict:
    """Fold sizes, singleton rate by fold, shard sizes. Each id must be in gt_s1 once."""
    if gt_s1.groupBy("s1_id").count().where("count > 1").head(1):
        raise ValueError("duplicate s1_id in the truth")
    joined = assigned.join(gt_s1, "s1_id", "left")
    if joined.where("n_matches is null").head(1):
        raise ValueError("an id has no truth row")
    folds = joined.groupBy("fold").agg(F.count("*").alias("n"), F.round(F.avg((F.col("n_matches") == 0).cast("double")), 6).alias("rate")).collect()
    sizes = assigned.groupBy("shard", "fold").count().collect()
    total: dict[int, int] = {}
    for r in sizes:
        total[r.shard] = total.get(r.shard, 0) + r["count"]
    return {
        **{f"n_{r.fold}": r.n for r in folds}, "singleton_rate": {r.fold: r.rate for r in folds}, "shard_sizes": dict(sorted(total.items())),
        "shard_sizes_val": {r.shard: r["count"] for r in sorted(sizes) if r.fold == "val"},
    }


def sample_groups(df: DataFrame, column: str, fraction: float, seed: int = vocab.SEED) -> DataFrame:
    """All rows of a seeded part of the groups."""
    return df.where(F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(1_000_000)) < int(fraction * 1_000_000))


def seeded_sample(df: DataFrame, n: int, *keys: str, seed: int = vocab.SEED) -> DataFrame:
    """n rows without replacement (all, if there are fewer), the same on every run."""
    return df.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys).limit(n)
