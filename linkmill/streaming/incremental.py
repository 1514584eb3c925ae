"""Matching of records that arrive one after another, against a fixed index: an extension beyond batch matching.

New records of source 1 are normalised, blocked and scored in each micro-batch with the batch operators; the index side's
keys are capped once and stay a table. Checkpointing and exactly-once files are Structured Streaming's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkmill.functions import vocab
from linkmill.operators import candidates, normalize


def index_keys(norm: DataFrame, cap: int = vocab.BLOCK_CAP) -> DataFrame:
    """Key rows of sources 2 and 3 whose groups hold at most cap records, with the group's size. Write it as a table."""
    keys = candidates.keys(norm.where("source <> 1"))
    sizes = keys.groupBy(*candidates.GROUP).agg(F.count("*").alias("n_index")).where(F.col("n_index") <= cap)
    return keys.join(sizes, candidates.GROUP)


def match_batch(records: DataFrame, index: DataFrame, norm: DataFrame, aliases: dict | None = None, prefilter_k: int = vocab.PREFILTER_K, top_k: int = vocab.TOP_K) -> DataFrame:
    """Candidates of one batch of source 1 records."""
    new = normalize.normalize(records.withColumn("source", F.lit(1).cast("byte")), aliases)
    kept = candidates.keys(new).withColumn("n_index", F.lit(None).cast("long")).unionByName(index)
    found = candidates.top(candidates.pairs(kept), prefilter_k, "key_weight")
    return candidates.top(candidates.scored(found, new.unionByName(norm.where("source <> 1"))), top_k, "cheap_score")


def match_stream(records: DataFrame, index: DataFrame, norm: DataFrame, out: str, checkpoint: str, aliases: dict | None = None, **options) -> StreamingQuery:
    """records: a streaming frame of source 1. Each batch's candidates are written under its number, so that a batch that
    is run again replaces its own rows."""

    def write(batch: DataFrame, number: int) -> None:
        match_batch(batch, index, norm, aliases, **options).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
