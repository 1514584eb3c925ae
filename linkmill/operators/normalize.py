"""Records to normal forms, in one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.functions import text as T

COLUMNS = (
    "entity_id", "source", "country", "name_norm", "name_core", "name_nospace", "name_has_url", "name_nonlatin",
    "addr_norm", "addr_core", "addr_nums", "addr_first_num", "addr_admin", "addr_empty",
)


def normalize(records: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """COLUMNS of records (entity_id, source, country, business_name, business_address). Steps that are used again are
    columns of their own, so each is computed once."""
    step = records.select(
        "entity_id", F.col("source").cast("byte").alias("source"), "country", T.name_norm("business_name").alias("name_norm"),
        T.has_url("business_name").alias("name_has_url"), T.nonlatin("business_name").alias("name_nonlatin"), T.address_parts("business_address").alias("__parts"),
    )
    step = step.withColumns({"__name": T.name_words(F.col("name_norm")), "__words": T.address_words(F.col("__parts"))})
    step = step.withColumns({"__admin": T.address_admin(F.col("__words"), aliases or {}), "__tokens": T.address_tokens(F.col("__words"))})
    admin, tokens, norm = F.col("__admin"), F.col("__tokens"), F.col("addr_norm")
    step = step.withColumn("addr_norm", F.array_join(F.flatten(tokens), " ")).withColumns({
        "name_core": T.name_core(F.col("name_norm"), F.col("__name")), "addr_core": T.address_core(tokens, admin, norm),
        "addr_admin": F.array_join(F.array_distinct(F.array_compact(admin)), " "), "__nums": T.numbers(norm),
    })
    return step.withColumns({
        "name_nospace": F.replace(F.col("name_core"), F.lit(" "), F.lit("")), "addr_nums": F.array_join("__nums", " "),
        "addr_first_num": F.coalesce(F.get("__nums", F.lit(0)), F.lit("")), "addr_empty": (F.col("addr_norm") == "").cast("byte"),
    }).select(*COLUMNS)


def shares(norm: DataFrame, *groups: str) -> DataFrame:
    """Rows and rates of empty names, empty addresses, first numbers and regions: for each group and, as ALL, for the total."""
    rate = lambda c: F.round(F.avg(c.cast("double")), 6)
    out = norm.cube(*groups).agg(
        F.count("*").alias("rows"), rate(F.col("name_core") == "").alias("empty_name"), rate(F.col("addr_empty") == 1).alias("empty_addr"),
        rate(F.col("addr_first_num") != "").alias("has_number"), rate(F.col("addr_admin") != "").alias("has_admin"),
        *(F.grouping(g).alias(f"__all_{g}") for g in groups),
    )
    for g in groups:
        out = out.withColumn(g, F.when(F.col(f"__all_{g}") == 1, F.lit("ALL")).otherwise(F.col(g).cast("string"))).drop(f"__all_{g}")
    return out
