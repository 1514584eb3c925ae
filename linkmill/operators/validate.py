"""Format rules of id-list files, as one pass over their lines and anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.sources.readers import first_column_ids
from linkmill.sources.writers import exists

MATCHING_HEADER, CANDIDATE_HEADER = ("source1_entity_id", "matched_entity_ids"), ("source1_entity_id", "candidate_entity_ids")
EXAMPLES = 5


def parsed(lines: DataFrame) -> DataFrame:
    """s1_id and ids of each line with a tab; a blank list is empty."""
    rest = F.expr("substring(value, instr(value, '\t') + 1)")
    ids = F.when(F.trim(rest) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ","))
    return lines.where(F.instr("value", "\t") > 0).select(F.substring_index("value", "\t", 1).alias("s1_id"), ids.alias("ids"))


def issues(rows: DataFrame, required: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """(rule, id) of every offender, each once: duplicate_row, repeated_id (by its row), self_match, bad_prefix, unknown_id
    (only with valid), missing, unexpected."""
    each = rows.select(F.explode("ids").alias("id")).distinct()
    rule = lambda df, c, name: df.select(F.lit(name).alias("rule"), F.col(c).alias("id"))
    known = F.col("id").startswith("S2-") | F.col("id").startswith("S3-")
    seen, need = rows.select(F.col("s1_id").alias("id")).distinct(), required.toDF("id").distinct()
    found = [
        rule(rows.groupBy("s1_id").count().where("count > 1"), "s1_id", "duplicate_row"),
        rule(rows.where(F.size("ids") > F.size(F.array_distinct("ids"))).select("s1_id").distinct(), "s1_id", "repeated_id"),
        rule(each.where(F.col("id").startswith("S1-")), "id", "self_match"), rule(each.where(~known & ~F.col("id").startswith("S1-")), "id", "bad_prefix"),
        rule(need.join(seen, "id", "left_anti"), "id", "missing"), rule(seen.join(need, "id", "left_anti"), "id", "unexpected"),
    ]
    if valid is not None:
        found.append(rule(each.where(known).join(valid.toDF("id"), "id", "left_anti"), "id", "unknown_id"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def summary(found: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """rule, total, and the first few offenders in order."""
    from pyspark.sql import Window

    w = Window.partitionBy("rule").orderBy("id")
    some = found.withColumn("__rank", F.row_number().over(w))
    return some.groupBy("rule").agg(F.count("*").alias("total"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("__rank") <= examples, F.col("id")))), ", ").alias("examples"))


def outside(matches: DataFrame, cand: DataFrame) -> DataFrame:
    """Matched pairs that are not candidates."""
    return matches.select("s1_id", "other_id").join(cand.select("s1_id", "other_id"), ["s1_id", "other_id"], "left_anti")


def check_matches_in_candidates(matches: DataFrame, cand: DataFrame) -> None:
    bad = outside(matches, cand)
    if bad.head(1):
        some = sorted(f"{r.s1_id}: {r.other_id}" for r in bad.orderBy("s1_id", "other_id").limit(EXAMPLES).collect())
        raise ValueError(f"{bad.select('s1_id').distinct().count()} ids have matches that are not candidates, e.g. {', '.join(some)}")


def check_known(pairs: DataFrame, ids: DataFrame) -> None:
    bad = pairs.select("s1_id").distinct().join(ids.select("s1_id"), "s1_id", "left_anti")
    if bad.head(1):
        some = [r.s1_id for r in bad.orderBy("s1_id").limit(EXAMPLES).collect()]
        raise ValueError(f"{bad.count()} ids are not in the list of source 1, e.g. {', '.join(some)}")


def validate_file(spark: SparkSession, path: str, header: tuple, required: DataFrame, valid: DataFrame | None = None) -> tuple[DataFrame | None, list[str]]:
    """(parsed rows or None, messages). A missing or empty file, commas for tabs and a wrong header end the check."""
    if not exists(spark, path):
        return None, [f"File not found: {path}"]
    lines = spark.read.text(path)
    top = lines.first()
    if top is None:
        return None, [f"{path} is empty."]
    if "\t" not in top.value and "," in top.value:
        return None, [f"{path}: the header has commas but no tab; the file must be tab-separated."]
    if tuple(c.strip().lower() for c in top.value.split("\t")) != tuple(header):
        return None, [f"{path}: unexpected header {top.value!r}; expected {list(header)}."]
    # the header is the first row of the first partition: a file's first split starts it
    body = lines.withColumn("__at", F.monotonically_increasing_id()).where("__at > 0").drop("__at")
    rows = parsed(body)
    messages = [f"{path}: row without a tab: {r.value!r}" for r in body.where((F.instr("value", "\t") == 0) & (F.trim("value") != "")).limit(EXAMPLES).collect()]
    messages += [f"{path}: {r.rule}: {r.total} in total, e.g. {r.examples}" for r in summary(issues(rows, required, valid)).orderBy("rule").collect()]
    return rows, messages


def validate(spark: SparkSession, matching: str, candidate: str | None, source1: str, targets: list[str] | None = None) -> tuple[list[str], list[str]]:
    """(errors, warnings) of the two output files. With targets (files of sources 2 and 3), ids must exist there. A missing
    candidate file, and matches that are no candidates, are warnings."""
    if not exists(spark, source1):
        return [f"File of source 1 not found: {source1}"], []
    errors, warnings = [], []
    required, valid = first_column_ids(spark, source1), None
    if targets and all(exists(spark, t) for t in targets):
        valid = first_column_ids(spark, targets[0])
        for t in targets[1:]:
            valid = valid.union(first_column_ids(spark, t))
    else:
        warnings.append("The existence of matched ids is not checked.")
    matched, found = validate_file(spark, matching, MATCHING_HEADER, required, valid)
    errors += found
    if candidate and exists(spark, candidate):
        cand, found = validate_file(spark, candidate, CANDIDATE_HEADER, required, valid)
        errors += found
        if matched is not None and cand is not None:
            pair = lambda r: r.select("s1_id", F.explode("ids").alias("other_id"))
            n = outside(pair(matched), pair(cand)).select("s1_id").distinct().count()
            if n:
                warnings.append(f"{n} ids have matches that are not candidates.")
    elif candidate:
        warnings.append(f"{candidate} not found; its checks are skipped.")
    return errors, warnings
