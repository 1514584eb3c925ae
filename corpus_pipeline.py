"""Corpus pipeline: quality, near duplicates, decontamination, secrets, packing.

Each stage takes all that the one before it kept, written as Parquet and read again. All but the last return the columns
of documents, whatever others the table has and whatever their names. Rows whose doc_id is null can't be named by a decision
on documents: near duplicates leave them, the other stages, which look at each row by itself, treat them like all rows. Null
and empty texts have no shingles, windows or secrets; the quality stage scores them as it does any text. Repeated rows are
near duplicates of each other. Texts of any length are read whole. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm._base import cut, ensure_checkpoint_dir, table, without
from linkmill.llm.decontaminate import contaminated_column
from linkmill.llm.jaccard_join import jaccard_components
from linkmill.llm.packing import pack
from linkmill.llm.quality import THRESHOLD, score_column
from linkmill.llm.quality import train as train_quality
from linkmill.llm.secret_scan import redacted

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near duplicates of the pipeline: words of a shingle, and percent of similarity.
WIDTH, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = train_quality(docs, table(spark, sf_dir, "labels"))
    return docs.select(*COLUMNS).where(score_column(docs, model) >= THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest id stays. Where ids repeat, rows of one id and different
    texts are documents of their own. No exchange moves the texts of all rows; see without()."""
    ids = docs.where("doc_id is not null").groupBy("doc_id").count()
    repeated = bool(ids.where("count > 1").head(1))
    own = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64("text").alias("h"))) if repeated else F.col("doc_id")
    keyed = docs.select(*COLUMNS, own.alias("__key"))
    found = jaccard_components(keyed.select(F.col("__key").alias("doc_id"), "text"), WIDTH, PERCENT).where("n_shingles > 0 and doc_id is not null")
    gone = cut(found.where("doc_id <> component_id").select(F.col("doc_id").alias("__key")).distinct())
    named = F.col("__key").isNotNull()
    kept = keyed.where(~named).unionByName(without(keyed.where(named), gone, "__key"))
    if repeated:  # rows of one id and one text: the first of those with words stays
        words = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]") & F.col("doc_id").isNotNull()
        once = kept.where(words).groupBy("__key").agg(F.min(F.struct(*COLUMNS)).alias("r")).select("r.*")
        return kept.where(~words).select(*COLUMNS).unionByName(once)
    return kept.select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return docs.select(*COLUMNS).where(~contaminated_column(docs, table(spark, sf_dir, "benchmark")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials are cut out of the texts, marked by whether their value is owner-specific or widely copied."""
    return redacted(docs, COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences."""
    return pack(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("packing", packing)]

#: A trained classifier decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage, over the documents of sf_dir. Stages are written to the shared checkpoint folder; each one is
    removed when the next is written, so that the last alone remains, for the rows returned."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            _remove(spark, f"{folder}/{k - 1}")
    return docs


def _remove(spark: SparkSession, path: str) -> None:
    """Through Spark's file systems, as the folder may be a remote one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
