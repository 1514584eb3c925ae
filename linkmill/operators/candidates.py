"""Blocking: keys, capped groups, pairs, rarity prefilter, cheap score.

The plan is one lazy query: records to keys by a single explode; group sizes on both sides, which partial sums make small;
semi-join of the keys with the groups that survive; equi-join on (country, bit, key), where adaptive execution splits
skewed keys; pairs are reduced before any text is fetched, and texts are joined only for the pairs that are scored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkmill.functions import text as T
from linkmill.functions import vocab
from linkmill.functions.similarity import scores

GROUP = ["country", "bit", "key"]


def _keys(kind: str) -> Column:
    """Array of the distinct keys of one family, from the columns that keys() prepares."""
    first, none = F.col("addr_first_num"), F.array().cast("array<string>")
    with_number = lambda words: F.when(first != "", F.transform(F.array_distinct(words), lambda t: F.concat_ws("|", first, t))).otherwise(none)
    if kind == "K1":
        return with_number(F.filter("__name", lambda t: F.length(t) >= 2))
    if kind == "K2":
        return with_number(F.filter("__letters", lambda t: F.length(t) >= 3))
    if kind == "K3":
        return F.flatten(F.transform("__names", lambda x: F.transform("__places", lambda y: F.concat_ws("|", x, y))))
    return F.when(F.length("name_nospace") >= 5, F.array(F.substring("name_nospace", 1, 8))).otherwise(none)


def keys(norm: DataFrame, families: tuple = tuple(vocab.KEY_BITS)) -> DataFrame:
    """(entity_id, source, country, bit, key): one row for each record and key. Word lists are columns of their own, so that
    they are computed once and not for each word that looks at them."""

    def family(k: str) -> Column:
        return F.transform(_keys(k), lambda x: F.struct(F.lit(vocab.KEY_BITS[k]).cast("byte").alias("bit"), x.alias("key")))

    words = norm.withColumns({"__name": T.tokens(F.col("name_core")), "__letters": F.filter(T.tokens(F.col("addr_core")), lambda t: t.rlike("^[a-z]+$"))})
    # of the longer words the first are taken, then made distinct
    words = words.withColumns({
        "__names": F.array_distinct(F.slice(F.filter("__name", lambda t: F.length(t) >= 3), 1, 4)),
        "__places": F.array_distinct(F.slice(F.filter("__letters", lambda t: F.length(t) >= 4), 1, 6)),
    })
    each = F.concat(*(family(k) for k in families))
    return words.select("entity_id", "source", "country", F.explode(each).alias("k")).select("entity_id", "source", "country", "k.bit", "k.key")


def group_sizes(all_keys: DataFrame) -> DataFrame:
    """n_index (sources 2 and 3) and n_query (source 1) of each key."""
    return all_keys.groupBy(*GROUP).agg(F.count_if(F.col("source") != 1).alias("n_index"), F.count_if(F.col("source") == 1).alias("n_query"))


def surviving(groups: DataFrame, cap: int = vocab.BLOCK_CAP) -> DataFrame:
    """Groups that stand on both sides with at most cap records each."""
    return groups.where((F.col("n_index") > 0) & (F.col("n_query") > 0) & (F.col("n_index") <= cap) & (F.col("n_query") <= cap))


def capped_keys(all_keys: DataFrame, cap: int = vocab.BLOCK_CAP) -> DataFrame:
    """Key rows of surviving groups, with the size of the index side."""
    return all_keys.join(surviving(group_sizes(all_keys), cap).drop("n_query"), GROUP)


def pairs(kept: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """(s1_id, other_id, key_hits, key_weight) of all pairs that share a key. `queries` (s1_id) limits the query side, after
    the caps were taken over all of it."""
    left = kept.where("source = 1").select(*GROUP, F.col("entity_id").alias("s1_id"))
    left = left if queries is None else left.join(queries, "s1_id", "left_semi")
    right = kept.where("source <> 1").select(*GROUP, F.col("entity_id").alias("other_id"), "n_index")
    weight = F.round(F.sum(1.0 / F.col("n_index")), 9)
    return left.join(right, GROUP).groupBy("s1_id", "other_id").agg(F.bit_or(F.col("bit").cast("int")).alias("key_hits"), weight.alias("key_weight"))


def top(df: DataFrame, k: int, score: str) -> DataFrame:
    """The k best rows of each s1_id; ties go to the smallest other_id."""
    w = Window.partitionBy("s1_id").orderBy(F.desc(score), "other_id")
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= k).drop("__rank")


def spread(df: DataFrame) -> DataFrame:
    """Dealt by s1_id to a fixed number of tasks: scoring costs far more time than the rows' bytes tell, which is what
    adaptive execution would size tasks by. Windows over an s1_id need no further exchange."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "s1_id")


def cheap_score(q, o) -> Column:
    """Half the names' token-set ratio, three tenths of the addresses', and a fifth for equal first numbers; 0 to 1."""
    s = scores([("token_set", q("name_core"), o("name_core")), ("token_set", q("addr_core"), o("addr_core"))])
    number = F.when((q("addr_first_num") != "") & (q("addr_first_num") == o("addr_first_num")), 20.0).otherwise(0.0)
    return F.round((0.5 * s["s0"] + 0.3 * s["s1"] + number) / 100.0, 9)


def scored(found: DataFrame, norm: DataFrame) -> DataFrame:
    """Pairs with cheap_score; texts are joined here, late."""
    columns = ("name_core", "addr_core", "addr_first_num")
    side = lambda id_, p, where: norm.where(where).select(F.col("entity_id").alias(id_), *(F.col(c).alias(f"{p}_{c}") for c in columns))
    full = spread(found.join(side("s1_id", "q", "source = 1"), "s1_id").join(side("other_id", "o", "source <> 1"), "other_id"))
    return full.withColumn("cheap_score", cheap_score(lambda c: F.col(f"q_{c}"), lambda c: F.col(f"o_{c}"))).select("s1_id", "other_id", "key_hits", "cheap_score", "key_weight")


def candidates(norm: DataFrame, cap: int = vocab.BLOCK_CAP, prefilter_k: int = vocab.PREFILTER_K, top_k: int = vocab.TOP_K, queries: DataFrame | None = None) -> DataFrame:
    """(s1_id, other_id, key_hits, cheap_score, key_weight): per s1_id the best pairs by rarity, then by cheap score."""
    found = pairs(capped_keys(keys(norm), cap), queries)
    return top(scored(top(found, prefilter_k, "key_weight"), norm), top_k, "cheap_score")


def blocking_report(norm: DataFrame, cand: DataFrame, cap: int = vocab.BLOCK_CAP) -> dict:
    """Key rows before and after the cap, dropped groups of the index side, pairs by key family, rate of s1 without any."""
    all_keys = keys(norm)
    groups = group_sizes(all_keys)
    raw = {(r.bit, r.index): r["count"] for r in all_keys.groupBy("bit", (F.col("source") != 1).alias("index")).count().collect()}
    kept = {r.bit: (r.i, r.q) for r in surviving(groups, cap).groupBy("bit").agg(F.sum("n_index").alias("i"), F.sum("n_query").alias("q")).collect()}
    dropped = groups.where(F.col("n_index") > cap).count()
    found = cand.agg(F.count("*").alias("n"), F.count_distinct("s1_id").alias("s1"), *(F.sum((F.col("key_hits").bitwiseAND(b) > 0).cast("long")).alias(k) for k, b in vocab.KEY_BITS.items())).first()
    total = norm.where("source = 1").count()
    countries = norm.select("entity_id", "country")
    crossing = (
        cand.select("s1_id", "other_id").join(countries.toDF("s1_id", "c1"), "s1_id").join(countries.toDF("other_id", "c2"), "other_id").where("c1 <> c2").count()
    )
    return {
        "index_rows_raw": {k: raw.get((b, True), 0) for k, b in vocab.KEY_BITS.items()}, "query_rows_raw": {k: raw.get((b, False), 0) for k, b in vocab.KEY_BITS.items()},
        "index_rows_kept": {k: kept.get(b, (0, 0))[0] for k, b in vocab.KEY_BITS.items()}, "query_rows_kept": {k: kept.get(b, (0, 0))[1] for k, b in vocab.KEY_BITS.items()},
        "index_groups_dropped_over_cap": dropped, "pairs": found.n, "pairs_per_s1": round(found.n / total, 3) if total else 0.0,
        "s1_with_zero_candidates": round(1 - found.s1 / total, 6) if total else None, "pairs_per_key": {k: found[k] or 0 for k in vocab.KEY_BITS}, "cross_country_pairs": crossing,
    }


def missed_pairs(truth: DataFrame, cand: DataFrame) -> DataFrame:
    return truth.join(cand, ["s1_id", "other_id"], "left_anti")


def show_misses(truth: DataFrame, cand: DataFrame, records: DataFrame, n: int = 10) -> DataFrame:
    """A seeded choice of missed pairs, with the raw texts of both sides."""
    from linkmill.operators.splits import seeded_sample

    some = seeded_sample(missed_pairs(truth, cand), n, "s1_id", "other_id")
    side = lambda id_, p: records.select(F.col("entity_id").alias(id_), F.col("business_name").alias(f"{p}_name"), F.col("business_address").alias(f"{p}_address"))
    return some.join(side("s1_id", "s1"), "s1_id").join(side("other_id", "other"), "other_id")
