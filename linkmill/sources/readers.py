"""Scans: tab-separated text, Parquet, JSON, ordered ids."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RECORD = ("entity_id", "business_name", "business_address", "country")
TRUTH = ("source1_entity_id", "matched_entity_ids")


def strings(names) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def read_tsv(spark: SparkSession, path: str, columns: tuple = RECORD, limit: int | None = None, check_header: bool = True) -> DataFrame:
    """Every value is text as it stands: no quotes, no escapes, no missing-value words; an empty field is an empty text."""
    if check_header:
        first = spark.read.text(path).first()
        if first is None or tuple(first.value.rstrip("\r").split("\t")) != tuple(columns):
            raise ValueError(f"{path}: columns {first and first.value.split(chr(9))}, not {list(columns)}")
    df = spark.read.csv(path, schema=strings(columns), sep="\t", header=True, quote="", escape="", nullValue="\x01", enforceSchema=True, encoding="UTF-8").na.fill("")
    return df if limit is None else df.limit(limit)


def read_parquet(spark: SparkSession, *paths: str, columns: list | None = None, where=None) -> DataFrame:
    """Several files are one table; columns and the predicate reach the scan."""
    df = spark.read.parquet(*paths)
    df = df if where is None else df.where(where)
    return df if columns is None else df.select(*columns)


def read_shards(spark: SparkSession, path: str, shards: list[int] | None = None) -> DataFrame:
    """A table partitioned by shard; only the listed folders are opened. An empty or missing table is an error."""
    df = spark.read.parquet(path)
    return df if shards is None else df.where(F.col("shard").isin(list(shards)))


def read_json(spark: SparkSession, path: str) -> dict:
    """A small document, through Spark's file systems."""
    rows = spark.read.text(path, wholetext=True).collect()
    return json.loads(rows[0].value)


def ordered_ids(df: DataFrame, column: str = "entity_id") -> DataFrame:
    """Ids with `ord`, their place in the file: partition and place in it, which the scan of one file keeps."""
    return df.select(F.col(column).alias("s1_id"), F.monotonically_increasing_id().alias("ord"))


def first_column_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct first fields of a tab-separated file, without its header and blank lines."""
    header = spark.read.text(path).first()
    ids = spark.read.text(path).select(F.trim(F.split("value", "\t")[0]).alias("id")).where("id <> ''").distinct()
    return ids.where(F.col("id") != header.value.split("\t")[0].strip()) if header else ids
