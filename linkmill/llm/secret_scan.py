r"""Secret scans by corpus-wide ownership frequency, with DataFrame operations alone.

Patterns give candidates with their places: matches and the pieces between them alternate, so running sums of their
lengths are the places. Each candidate's value is hashed; over the whole corpus a hash is counted by distinct
repositories (documents) and distinct owners (sources). A value that OWNERS or more owners hold, or REPOSITORIES or more
repositories of whatever owners, is a widely copied example; any other one that looks random is a live credential, and its
value becomes a span of kind `live`.

The texts are scanned once, to a digest of the matches, kept in the shared folder. Rows without a match go no further.
Counting reduces (hash, owner, repository) step by step, with partial sums before each exchange. The hashes of examples, few
beside all, meet the candidates under SALTS salts, so a value that a third of all documents share is spread over tasks.

Places are in code points, ends exclusive. Null and empty texts have no spans. Repeated rows keep a result each. A null
owner counts as an owner of its own. Texts of any length are scanned whole. Other columns of the input are not read, so
their names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm._base import cut, table

#: The kinds in order, their patterns (group 1: the value) and the least length of a value.
KINDS = ("assign", "access", "hex")
PATTERNS = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    r"""(AKIA[A-Z0-9]{16,})""",  # the same as all runs, then those of 20 and more
    r"""([0-9a-f]{24,})""",  # likewise
)
LEAST = (6, 20, 24)
#: Owners and repositories from which a value counts as widely copied, and the least length of a live-looking one.
OWNERS, REPOSITORIES, LIVE_LENGTH = 3, 100, 12
SALTS = 16
SPAN = "struct<start: int, kind: int, end: int, value_start: int, hash: bigint, random: boolean>"


def _spans(text: Column, kind: int) -> Column:
    """Spans of one kind, of a text that has matches of it."""
    matches, values = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)), F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(1))
    rows = F.arrays_zip(F.split(text, PATTERNS[kind], -1).alias("p"), matches.alias("m"), values.alias("v"))
    none = F.array().cast(f"array<{SPAN}>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["p"])
        end = start + F.length(x["m"])
        looks = (F.length(x["v"]) >= LIVE_LENGTH) & x["v"].rlike("[0-9]") & x["v"].rlike("[A-Za-z]")
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), (end - F.length(x["v"])).alias("value_start"), F.xxhash64(x["v"]).alias("hash"), looks.alias("random"))
        keep = F.coalesce(F.length(x["v"]) >= LEAST[kind], F.lit(False))  # the last piece has no match after it
        return F.struct(F.coalesce(end, start).alias("at"), F.when(keep, F.concat(state["found"], F.array(span).cast(f"array<{SPAN}>"))).otherwise(state["found"]).alias("found"))

    return F.aggregate(rows, F.struct(F.lit(0).alias("at"), none.alias("found")), step, lambda s: s["found"])


def candidates(docs: DataFrame, owner: str = "source", keep: tuple = ()) -> DataFrame:
    """doc_id, the owner, the kept columns, and base: the spans of all kinds in order. One scan, without a shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    found = [F.when(text.rlike(p), _spans(text, k)).otherwise(none) for k, p in enumerate(PATTERNS)]
    kept = [F.col(f"`{c}`") for c in keep]
    return docs.select("doc_id", F.col(owner).cast("string").alias("__owner"), F.array_sort(F.concat(*found)).alias("base"), *kept)


def ownership(found: DataFrame) -> DataFrame:
    """hash, n_repositories and n_owners of each candidate value of the corpus."""
    each = found.where(F.size("base") > 0).select(F.explode("base.hash").alias("hash"), F.coalesce(F.col("__owner"), F.lit("")).alias("owner"), "doc_id").distinct()
    by_owner = each.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))


def classified(found: DataFrame, owners: int = OWNERS, repositories: int = REPOSITORIES) -> DataFrame:
    """found (with __row, a number of each row) and live: those of its base spans that are owner-specific and look random."""
    spread = lambda row: F.pmod(F.xxhash64(row), F.lit(SALTS))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    copied = ownership(found).where((F.col("n_owners") >= owners) | (F.col("n_repositories") >= repositories)).select("hash", salts)
    each = found.where(F.size("base") > 0).select("__row", F.explode("base").alias("s")).where("s.random").select("__row", "s", F.col("s.hash").alias("hash"), spread("__row").alias("salt"))
    live = each.join(copied, ["hash", "salt"], "left_anti").groupBy("__row").agg(F.array_sort(F.collect_list("s")).alias("live"))
    none = F.array().cast(f"array<{SPAN}>")
    matched = found.where(F.size("base") > 0).join(live, "__row", "left").withColumn("live", F.coalesce("live", none))
    return matched.unionByName(found.where(F.size("base") == 0).withColumn("live", none))


def joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in (*KINDS, "live")))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def secret_scan(docs: DataFrame, owner: str = "source", owners: int = OWNERS) -> DataFrame:
    """doc_id, base and live spans of every row."""
    found = cut(candidates(docs, owner).withColumn("__row", F.monotonically_increasing_id()))
    return classified(found, owners).select("doc_id", "base", "live")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(table(spark, sf_dir, "documents"))
    live = F.transform("live", lambda s: F.struct(s["value_start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["end"].alias("end")))
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", *(count(k) for k in range(len(KINDS))), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.array_sort(F.array_distinct(F.concat(base, live)))).alias("spans"))


def redacted(docs: DataFrame, columns: list[str], owner: str = "source", owners: int = OWNERS) -> DataFrame:
    """The columns, with candidates cut out of the texts: [SECRET] for live ones, [EXAMPLE] for others. n_chars, if it is
    among the columns, follows. Texts without a match go through as they are; only the others are kept and joined."""
    has = F.lit(False)
    for p in PATTERNS:
        has = has | F.coalesce(F.col("text").rlike(p), F.lit(False))
    found = cut(candidates(docs.where(has), owner, tuple(c for c in columns if c != "doc_id")).withColumn("__row", F.monotonically_increasing_id()))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        mark = F.when(F.array_contains("live", s), "[SECRET]").otherwise("[EXAMPLE]")
        new = s["end"] > state["at"]  # a span inside of one before it is gone already
        out = F.when(new, F.concat(state["out"], gap, F.when(s["start"] >= state["at"], mark).otherwise(""))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    rest = lambda t: F.concat(t["out"], F.substring(F.col("text"), t["at"] + 1, F.length("text")))
    text = F.aggregate("base", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, rest)
    clean = classified(found, owners).withColumn("text", F.when(F.size("base") > 0, text).otherwise(F.col("text")))
    if "n_chars" in columns:
        clean = clean.withColumn("n_chars", F.when(F.size("base") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    names = [F.col(f"`{c}`") for c in columns]
    return docs.where(~has).select(*names).unionByName(clean.select(*names))
