"""Shared plumbing of the text operators: reading, Arrow mapping, lineage cuts."""

from __future__ import annotations

import math
import re
import tempfile
from collections.abc import Callable, Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Documents that come in fewer splits than there are cores (a small file) are dealt out first."""
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name == "documents" and df.rdd.getNumPartitions() < cores else df


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the folder the cluster names in spark.checkpoint.dir; set one only where it is unset and driver and workers are
    one process (tests). On a cluster an unset folder is an error, as workers don't see the driver's disk."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and re.fullmatch(r"local(\[.*\])?", sc.master) is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="linkmill-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Compute df once, into the shared checkpoint folder; later stages and lost executors read it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def small_batches(spark: SparkSession) -> None:
    """Texts cross to Python some hundred at a time, so that neither side holds a whole partition of them at once. Workers
    that share the driver's disk find this package where the driver found it; others need --py-files."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")


def map_batches(df: DataFrame, columns: list, ddl: str, make: Callable[[], Callable[[pa.RecordBatch], Iterator[list]]], ended: bool = False) -> DataFrame:
    """mapInArrow over the named columns only. make() runs once a task and returns a function that yields lists of
    column values (in the order of ddl) for each batch; if asked for, it is called with None at the end."""
    schema = StructType.fromDDL(ddl)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        work = make()
        for batch in chain(batches, [None] * ended):
            for out in work(batch):
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, type=f.type) for x, f in zip(out, arrow, strict=True)], schema=arrow)

    return df.select(*columns).mapInArrow(run, schema)


#: Logarithm of the most bits of a sieve: 32 MB. A fuller one lets more pass, which an exact join decides.
MOST_SIEVE = 28


def make_sieve(hashes: DataFrame) -> np.ndarray:
    """A bitmap in which two bits of each hash (the one column, long) are set, from its lower and its upper half: 16 bits a
    hash and 2 ** MOST_SIEVE at most. It is put together from words of 64 bits by partial sums, so the driver gets
    2 ** (MOST_SIEVE - 6) rows at most, whatever the number of hashes."""
    h = hashes.columns[0]
    bits = min(MOST_SIEVE, max(12, math.ceil(math.log2(16 * (hashes.count() + 1)))))
    mask = F.lit((1 << bits) - 1)
    places = hashes.select(F.explode(F.array(F.col(h).bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask))).alias("p"))
    words = places.select(F.shiftright("p", 6).alias("i"), F.expr("shiftleft(1L, cast(p & 63L as int))").alias("w")).groupBy("i").agg(F.bit_or("w").alias("w")).toPandas()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["i"].to_numpy(np.int64)] = words["w"].to_numpy(np.int64).astype(np.uint64)
    return out


def passes(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be one of the sieve's; those that are always pass."""
    h = hashes.astype(np.uint64)
    mask = np.uint64(64 * len(sieve) - 1)
    out = np.ones(len(h), np.uint64)
    for p in (h & mask, (h >> np.uint64(32)) & mask):
        out &= sieve[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))
    return (out & np.uint64(1)).astype(bool)


def passing(sieve: np.ndarray, spark: SparkSession, h):
    """passes() as a column, of a column of hashes; other columns don't leave the JVM."""
    shared = spark.sparkContext.broadcast(sieve)
    return F.pandas_udf(lambda x: pd.Series(passes(shared.value, x.to_numpy())), "boolean")(h)


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """rows whose key (never null there) is not among `gone` (distinct keys). One way at every size, without an exchange of all
    rows: what a sieve of the gone holds back is kept; of what passes, keys alone meet the gone, and those that are kept make
    a second sieve; what it holds back is gone; the few rows that pass both are decided by a join."""
    spark = rows.sparkSession
    h = F.xxhash64(key)
    gone = cut(gone.select(key, h.alias("__h")))
    first = passing(make_sieve(gone.select("__h")), spark, F.col("__h"))
    hashed = rows.withColumn("__h", h)
    wrong = hashed.select(key, "__h").where(first).join(gone.select(key), key, "left_anti").select("__h").distinct()
    second = passing(make_sieve(cut(wrong)), spark, F.col("__h"))
    marked = hashed.withColumn("__in", F.coalesce(first, F.lit(False)))
    open_ = marked.where("__in").where(second).join(gone.select(key), key, "left_anti").select(*rows.columns)
    return marked.where(~F.col("__in")).select(*rows.columns).unionByName(open_)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, rows: int) -> DataFrame:
    """(text, y) of at most `rows` labelled documents whose crc32(doc_id as text) mod `modulus` is not `remainder`.

    The bound is the caller's documented parameter; rows are those with the smallest hashes of their ids, so the choice is
    the same on every run. The chosen ids, `rows` at most, are the broadcast side: the texts are never shuffled."""
    ident = F.col("doc_id").cast("string")
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (F.crc32(ident) % modulus != remainder))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "y")


def held_out(modulus: int, remainder: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


def slices(codes: np.ndarray, size: int, overlap: int) -> Iterator[np.ndarray]:
    """Pieces of a long array that overlap, so that a window of overlap + 1 items is whole in one of them."""
    for start in range(0, max(len(codes), 1), size):
        yield codes[start : start + size + overlap]
