"""Sinks: Parquet with skip-if-there, ordered id lists, JSON and Markdown reports. All paths go through Spark's file
systems, so the folders may be in any store."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished table or file is there."""
    fs, p = _path(spark, path)
    return fs.exists(p) and (fs.getFileStatus(p).isFile() or fs.exists(_path(spark, f"{path}/_SUCCESS")[1]))


def write_parquet(df: DataFrame, path: str, force: bool = False, partition_by: str | None = None, parts: list | None = None) -> bool:
    """Written as a whole or not at all; an existing table is kept unless forced. Whether it was written. With parts, the
    table is written and kept by those values of its partition column; its other parts stay as they are."""
    spark = df.sparkSession
    there = exists(spark, path) if parts is None else all(_exists(spark, f"{path}/{partition_by}={v}") for v in parts)
    if there and not force:
        return False
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static" if parts is None else "dynamic")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    if not exists(spark, path):
        write_text(spark, f"{path}/_SUCCESS", "")
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_json(spark: SparkSession, path: str, report: dict) -> None:
    write_text(spark, path, json.dumps(report, indent=2, ensure_ascii=False) + "\n")


def id_lists(ids: DataFrame, pairs: DataFrame, order: list | None = None) -> DataFrame:
    """ord, s1_id and line (`id<TAB>id,id,...`) for each ordered id; only S2- and S3- ids, each once, at its first place."""
    order = order or [F.col("other_id")]
    listed = pairs.where(F.col("other_id").startswith("S2-") | F.col("other_id").startswith("S3-"))
    window = Window.partitionBy("s1_id").orderBy(*order, "other_id")
    ranked = listed.withColumn("__rank", F.row_number().over(window)).groupBy("s1_id").agg(F.array_sort(F.collect_list(F.struct("__rank", "other_id"))).alias("l"))
    joined = ids.join(ranked, "s1_id", "left").withColumn("list", F.array_distinct(F.coalesce(F.col("l.other_id"), F.array().cast("array<string>"))))
    return joined.select("ord", "s1_id", F.concat_ws("\t", "s1_id", F.array_join("list", ",")).alias("line"))


def write_id_lists(ids: DataFrame, pairs: DataFrame, path: str, header: str, order: list | None = None) -> None:
    """One text file: a header, then a line for each id in order. Sorted in parallel; parts are joined in their order."""
    spark = ids.sparkSession
    parts = f"{path}.parts"
    id_lists(ids, pairs, order).orderBy("ord").select("line").write.mode("overwrite").text(parts)
    fs, target = _path(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(f"source1_entity_id\t{header}\n".encode()))
        files = sorted((s.getPath() for s in fs.listStatus(_path(spark, parts)[1]) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
        for p in files:
            part = fs.open(p)
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 65536, False)
            part.close()
    finally:
        out.close()
    fs.delete(_path(spark, parts)[1], True)


def alias_markdown(mappings: list[dict], canonicals: list[tuple[str, int]], checks: list[str], top: int = 60) -> str:
    """Report of learned aliases: mappings by country, canonicals by frequency, the sanity list."""
    lines = ["# Aliases", "", f"{len(canonicals)} canonicals, {len(mappings)} variants", ""]
    shown = sorted(mappings, key=lambda m: (-m["count"], m["variant"]))[:top]
    for country in sorted({m["country"] for m in shown}):
        lines += [f"## {country}", "", "| variant | canonical | count | occurrences |", "|-|-|-|-|"]
        lines += [f"| {m['variant']} | {m['canonical']} | {m['count']} | {m['occurrences']} |" for m in shown if m["country"] == country]
        lines.append("")
    return "\n".join([*lines, "## Canonicals", "", ", ".join(f"{c} ({n})" for c, n in canonicals), "", "## Checks", "", *(f"- {x}" for x in checks), ""])
