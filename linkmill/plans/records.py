"""Business records derived from the shared text tables, and the truth among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkmill.functions import vocab
from linkmill.functions.text import basic_clean
from linkmill.operators import candidates, normalize

#: Regions of the derived addresses, for the queries that look regions up.
ALIASES = {"src1": "north", "src2": "south", "src3": "north", "src4": "src4"}
#: Limits of the registered queries and of their SQL.
CAP, PREFILTER = vocab.BLOCK_CAP, vocab.PREFILTER_K


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; a small file, in fewer splits than there are cores, is dealt out first."""
    docs, cores = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() < cores else docs


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang", "source", "n_chars")
    # ten words are used; the eleventh piece is the rest of the text, uncut
    words = F.slice(F.split(F.trim(F.substring_index(F.coalesce("text", F.lit("")), "\x00", 1)), r"\s+", 11), 1, 10)
    source = F.pmod(F.col("doc_id"), F.lit(3)) + 1
    address = F.concat(F.pmod(F.coalesce("n_chars", F.lit(0)), F.lit(50)).cast("string"), F.lit(" "), F.array_join(F.slice("w", 5, 6), " "), F.lit(", "), F.coalesce("source", F.lit("")))
    return docs.withColumn("w", words).select(
        F.concat(F.lit("S"), source.cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"), source.cast("byte").alias("source"),
        F.col("lang").alias("country"), F.array_join(F.slice("w", 1, 4), " ").alias("business_name"), address.alias("business_address"),
    )


def norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize(records(spark, sf_dir), ALIASES)


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s1_id, country of all records of source 1."""
    return records(spark, sf_dir).where("source = 1").select(F.col("entity_id").alias("s1_id"), "country")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of source 1 and others of one language and one cleaned text; an other record belongs to the smallest s1_id."""
    docs = _documents(spark, sf_dir)
    source = (F.pmod(F.col("doc_id"), F.lit(3)) + 1).cast("string")
    e = docs.select(F.concat(F.lit("S"), source, F.lit("-"), F.col("doc_id").cast("string")).alias("id"), source.alias("source"), "lang", F.md5(basic_clean(F.coalesce("text", F.lit(""))).cast("binary")).alias("h"))
    first = e.where("source = '1'").groupBy("lang", "h").agg(F.min("id").alias("s1_id"))
    return e.where("source <> '1'").join(first, ["lang", "h"]).select("s1_id", F.col("id").alias("other_id"))


def rarity_candidates(spark: SparkSession, sf_dir: str, cap: int = CAP, prefilter_k: int = PREFILTER) -> DataFrame:
    """Candidates whose cheap_score is the key weight on a scale from 0 to 1: no text similarity, so SQL can follow."""
    found = candidates.top(candidates.pairs(candidates.capped_keys(candidates.keys(norm(spark, sf_dir)), cap)), prefilter_k, "key_weight")
    return found.withColumn("cheap_score", F.round(F.col("key_weight") / (1 + F.col("key_weight")), 6))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("other_id").orderBy(F.desc("prob"), "s1_id")
    scored = rarity_candidates(spark, sf_dir).select("s1_id", "other_id", F.col("cheap_score").alias("prob"))
    return scored.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
