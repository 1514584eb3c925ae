"""Registered queries of the library's own operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.functions import text as T
from linkmill.functions import vocab
from linkmill.functions.similarity import similarity
from linkmill.operators import aliases, assign, candidates, evaluate, features, ingest, normalize, splits, validate
from linkmill.plans import records as R
from linkmill.plans import sql as S
from linkmill.sources import readers, writers

QUERIES: dict = {}
SQL: dict[str, str] = {}
THRESHOLD = 0.3
NATIVE = ("name_jacc", "addr_jacc", "num_jacc", "s1_num_share", "first_num_eq", "admin_eq", "name_len_ratio", "addr_len_ratio", "key_k1", "key_k2", "key_k3", "key_k4")


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            SQL[name or f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(SQL)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder; a local one only where none is named (tests)."""
    import tempfile
    import uuid

    top = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="linkmill-")
    return f"{top}/{name}-{uuid.uuid4().hex}"


# Records and normal forms


@query(S.w(S.RECORDS) + "SELECT * FROM r")
def er_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.records(spark, sf_dir)


@query(S.w(S.RECORDS) + f"SELECT entity_id, {S.clean('business_name')} AS name, {S.clean('business_address')} AS address FROM r")
def er_clean_text(spark, sf_dir):
    return R.records(spark, sf_dir).select("entity_id", T.basic_clean(F.col("business_name")).alias("name"), T.basic_clean(F.col("business_address")).alias("address"))


@query(f"SELECT doc_id, {S.clean('text')} AS text FROM documents")
def er_clean_documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", T.basic_clean(F.coalesce("text", F.lit(""))).alias("text"))


@query(S.w(S.NORM) + "SELECT * FROM norm")
def er_norm(spark, sf_dir):
    return R.norm(spark, sf_dir)


@query(S.w(S.NORM) + "SELECT entity_id, name_norm, name_core, name_nospace, name_has_url FROM norm")
def er_name_norm(spark, sf_dir):
    return R.norm(spark, sf_dir).select("entity_id", "name_norm", "name_core", "name_nospace", "name_has_url")


@query(S.w(S.NORM) + "SELECT entity_id, addr_norm, addr_core, addr_admin, addr_empty FROM norm")
def er_addr_norm(spark, sf_dir):
    return R.norm(spark, sf_dir).select("entity_id", "addr_norm", "addr_core", "addr_admin", "addr_empty")


@query(S.w(S.NORM) + "SELECT entity_id, addr_nums, addr_first_num FROM norm")
def er_first_num(spark, sf_dir):
    return R.norm(spark, sf_dir).select("entity_id", "addr_nums", "addr_first_num")


@query(S.w(S.NORM) + "SELECT entity_id, array_to_string(parts[greatest(len(parts) - 1, 1):len(parts)], '|') AS tail FROM n1")
def er_tail_parts(spark, sf_dir):
    return R.records(spark, sf_dir).select("entity_id", F.array_join(T.tail_parts("business_address"), "|").alias("tail"))


_SHARES = "count(*) AS rows, round(avg((name_core = '')::INT), 6) AS empty_name, round(avg(addr_empty), 6) AS empty_addr, round(avg((addr_first_num <> '')::INT), 6) AS has_number, round(avg((addr_admin <> '')::INT), 6) AS has_admin"


@query(S.w(S.NORM) + f"SELECT CASE WHEN grouping(source) = 1 THEN 'ALL' ELSE source::VARCHAR END AS source, CASE WHEN grouping(country) = 1 THEN 'ALL' ELSE country END AS country, {_SHARES} FROM norm GROUP BY CUBE (source, country)")
def er_norm_shares(spark, sf_dir):
    return normalize.shares(R.norm(spark, sf_dir), "source", "country")


# Blocking

for _k, _b in vocab.KEY_BITS.items():

    @query(S.w(S.KEYS) + f"SELECT * FROM keys WHERE bit = {_b}", f"er_keys_{_k.lower()}")
    def _family(spark, sf_dir, family=_k):
        return candidates.keys(R.norm(spark, sf_dir), (family,))


@query(S.w(S.KEYS) + "SELECT * FROM keys")
def er_keys_all(spark, sf_dir):
    return candidates.keys(R.norm(spark, sf_dir))


@query(S.w(S.KEYS) + "SELECT bit, count(*) AS n FROM keys GROUP BY bit ORDER BY bit")
def er_keys_per_bit(spark, sf_dir):
    return candidates.keys(R.norm(spark, sf_dir)).groupBy("bit").agg(F.count("*").alias("n")).orderBy("bit")


@query(S.w(S.GROUPS) + "SELECT * FROM groups")
def er_key_groups(spark, sf_dir):
    return candidates.group_sizes(candidates.keys(R.norm(spark, sf_dir)))


@query(S.w(S.CAPPED) + "SELECT * FROM capped")
def er_keys_capped(spark, sf_dir):
    return candidates.capped_keys(candidates.keys(R.norm(spark, sf_dir)), R.CAP)


@query(S.w(S.GROUPS) + f"SELECT bit, count(*) FILTER (n_index > {R.CAP}) AS over_cap, count(*) FILTER (n_index = 0 OR n_query = 0) AS one_sided FROM groups GROUP BY bit")
def er_groups_dropped(spark, sf_dir):
    g = candidates.group_sizes(candidates.keys(R.norm(spark, sf_dir)))
    return g.groupBy("bit").agg(F.count_if(F.col("n_index") > R.CAP).alias("over_cap"), F.count_if((F.col("n_index") == 0) | (F.col("n_query") == 0)).alias("one_sided"))


def _part_keys(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    source = (F.pmod("p_partkey", F.lit(3)) + 1).cast("byte")
    return part.select(F.col("p_partkey").cast("string").alias("entity_id"), source.alias("source"), F.lit("all").alias("country"), F.lit(1).cast("byte").alias("bit"), F.explode(F.split("p_name", " ")).alias("key")).distinct()


_PART = "pk AS (SELECT DISTINCT p_partkey::VARCHAR AS entity_id, (1 + p_partkey % 3)::TINYINT AS source, 'all' AS country, 1::TINYINT AS bit, unnest(string_split(p_name, ' ')) AS key FROM part), pg AS (SELECT country, bit, key, count(*) FILTER (source <> 1) AS n_index, count(*) FILTER (source = 1) AS n_query FROM pk GROUP BY ALL)"


@query(f"WITH {_PART} SELECT * FROM pg WHERE n_index BETWEEN 1 AND 200 AND n_query BETWEEN 1 AND 200")
def er_part_cap(spark, sf_dir):
    return candidates.surviving(candidates.group_sizes(_part_keys(spark, sf_dir)), 200)


@query(S.w(S.PAIRS) + "SELECT * FROM pairs")
def er_pairs_key_hits(spark, sf_dir):
    return candidates.pairs(candidates.capped_keys(candidates.keys(R.norm(spark, sf_dir)), R.CAP))


@query(S.w(S.CAND) + "SELECT s1_id, other_id, key_hits, key_weight FROM cand")
def er_prefilter_topn(spark, sf_dir):
    return R.rarity_candidates(spark, sf_dir).drop("cheap_score")


@query(S.w(S.CAND) + "SELECT s1_id, other_id, key_hits, key_weight, cheap_score FROM cand")
def er_candidates(spark, sf_dir):
    """The flagship: records to keys, capped groups, pairs, rarity prefilter."""
    return R.rarity_candidates(spark, sf_dir)


@query(S.w(S.PAIRS, S.TRUTH) + "SELECT * FROM pairs WHERE s1_id IN (SELECT s1_id FROM truth)")
def er_semi_pairs(spark, sf_dir):
    kept = candidates.capped_keys(candidates.keys(R.norm(spark, sf_dir)), R.CAP)
    return candidates.pairs(kept, R.truth(spark, sf_dir).select("s1_id").distinct())


@query(S.w(S.SCORED) + "SELECT s1_id, other_id, key_hits, cheap_score, key_weight FROM scored")
def er_scored_candidates(spark, sf_dir):
    return candidates.candidates(R.norm(spark, sf_dir))


# Pairs and features


def _native(spark, sf_dir):
    df = features.enriched(R.rarity_candidates(spark, sf_dir), R.norm(spark, sf_dir))
    q, o = (lambda c: F.col(f"q_{c}")), (lambda c: F.col(f"o_{c}"))
    gate = (q("addr_norm") == "") | (o("addr_norm") == "")
    return df.select(
        "s1_id", "other_id", T.jaccard(q("name_core"), o("name_core")).alias("name_jacc"), F.when(gate, -1.0).otherwise(T.jaccard(q("addr_core"), o("addr_core"))).alias("addr_jacc"),
        T.number_jaccard(q("addr_nums"), o("addr_nums")).alias("num_jacc"), T.number_share(q("addr_nums"), o("addr_nums")).alias("s1_num_share"),
        T.equal3(q("addr_first_num"), o("addr_first_num")).alias("first_num_eq"), T.admin_equal(q("addr_admin"), o("addr_admin")).alias("admin_eq"),
        T.length_ratio(q("name_core"), o("name_core")).alias("name_len_ratio"), T.length_ratio(q("addr_norm"), o("addr_norm")).alias("addr_len_ratio"),
        *((F.col("key_hits").bitwiseAND(b) > 0).cast("double").alias(f"key_{k.lower()}") for k, b in vocab.KEY_BITS.items()),
    )


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("s1_id", "other_id", *(F.round(c, 6).alias(c) for c in df.columns if c in NATIVE))


def _jacc(a: str, b: str) -> str:
    x, y = S.words(a), S.words(b)
    return f"CASE WHEN len({x}) + len({y}) = 0 THEN -1.0::DOUBLE ELSE len(list_intersect({x}, {y}))::DOUBLE / len(list_distinct(list_concat({x}, {y}))) END"


def _len(a: str, b: str) -> str:
    return f"CASE WHEN greatest(length({a}), length({b})) = 0 THEN 0.0 ELSE least(length({a}), length({b}))::DOUBLE / greatest(length({a}), length({b})) END"


_FEATURES = f"""
enr AS (SELECT c.*, {", ".join(f"a.{x} AS q_{x}, o.{x} AS o_{x}" for x in ("name_core", "addr_norm", "addr_core", "addr_nums", "addr_first_num", "addr_admin"))} FROM cand c JOIN norm a ON a.entity_id = c.s1_id JOIN norm o ON o.entity_id = c.other_id),
feat AS (SELECT s1_id, other_id, round({_jacc("q_name_core", "o_name_core")}, 6) AS name_jacc,
 CASE WHEN q_addr_norm = '' OR o_addr_norm = '' THEN -1.0 ELSE round({_jacc("q_addr_core", "o_addr_core")}, 6) END AS addr_jacc,
 CASE WHEN q_addr_nums = '' OR o_addr_nums = '' THEN -1.0 ELSE round({_jacc("q_addr_nums", "o_addr_nums")}, 6) END AS num_jacc,
 CASE WHEN q_addr_nums = '' THEN -1.0 ELSE round(len(list_intersect({S.words("q_addr_nums")}, {S.words("o_addr_nums")}))::DOUBLE / len(list_distinct({S.words("q_addr_nums")})), 6) END AS s1_num_share,
 CASE WHEN q_addr_first_num = '' OR o_addr_first_num = '' THEN -1.0::DOUBLE WHEN q_addr_first_num = o_addr_first_num THEN 1.0 ELSE 0.0 END AS first_num_eq,
 CASE WHEN q_addr_admin = '' OR o_addr_admin = '' THEN -1.0::DOUBLE WHEN list_has_any({S.words("q_addr_admin")}, {S.words("o_addr_admin")}) THEN 1.0 ELSE 0.0 END AS admin_eq,
 round({_len("q_name_core", "o_name_core")}, 6) AS name_len_ratio, round({_len("q_addr_norm", "o_addr_norm")}, 6) AS addr_len_ratio,
 {", ".join(f"((key_hits & {b}) > 0)::INT::DOUBLE AS key_{k.lower()}" for k, b in vocab.KEY_BITS.items())} FROM enr)"""


@query(S.w(S.CAND, _FEATURES) + "SELECT * FROM feat")
def er_native_features(spark, sf_dir):
    return _rounded(_native(spark, sf_dir))


@query(S.w(S.CAND, _FEATURES) + "SELECT s1_id, other_id, name_jacc, addr_jacc FROM feat")
def er_jaccard_pairs(spark, sf_dir):
    return _rounded(_native(spark, sf_dir)).select("s1_id", "other_id", "name_jacc", "addr_jacc")


@query(S.w(S.CAND, _FEATURES) + "SELECT s1_id, other_id, num_jacc, s1_num_share, first_num_eq FROM feat")
def er_num_features(spark, sf_dir):
    return _rounded(_native(spark, sf_dir)).select("s1_id", "other_id", "num_jacc", "s1_num_share", "first_num_eq")


@query(S.w(S.CAND) + "SELECT DISTINCT a.name_core AS a, o.name_core AS b, round(jaro_winkler_similarity(a.name_core, o.name_core), 6) AS score FROM cand c JOIN norm a ON a.entity_id = c.s1_id JOIN norm o ON o.entity_id = c.other_id WHERE a.name_core <> '' AND o.name_core <> ''")
def er_jaro_winkler(spark, sf_dir):
    df = features.enriched(R.rarity_candidates(spark, sf_dir), R.norm(spark, sf_dir)).select(F.col("q_name_core").alias("a"), F.col("o_name_core").alias("b")).distinct()
    return df.where("a <> '' and b <> ''").withColumn("score", F.round(similarity("jaro_winkler", F.col("a"), F.col("b")), 6))


def _name_pairs(spark, sf_dir):
    return features.enriched(R.rarity_candidates(spark, sf_dir), R.norm(spark, sf_dir)).select(F.col("q_name_core").alias("a"), F.col("o_name_core").alias("b")).distinct()


_NAMES = "np AS (SELECT DISTINCT a.name_core AS a, o.name_core AS b FROM cand c JOIN norm a ON a.entity_id = c.s1_id JOIN norm o ON o.entity_id = c.other_id)"
_SORTED = lambda x: S.join(f"list_sort({S.words(x)})")


@query(S.w(S.CAND, _NAMES, S.lcs("SELECT a AS x, b AS y FROM np UNION SELECT " + _SORTED("a") + ", " + _SORTED("b") + " FROM np UNION " + S.rests("np", "a", "b")))
    + f"SELECT a, b, round({S.ratio('a', 'b', 'r.n')}, 6) AS ratio, round({S.ratio(_SORTED('a'), _SORTED('b'), 't.n')}, 6) AS token_sort, round({S.token_set('a', 'b', 's.n')}, 6) AS token_set FROM np"
    + f" JOIN lcs r ON r.x = a AND r.y = b JOIN lcs t ON t.x = {_SORTED('a')} AND t.y = {_SORTED('b')} JOIN lcs s ON s.x = {S.rest('a', 'b')} AND s.y = {S.rest('b', 'a')}")
def er_similarities(spark, sf_dir):
    a, b = F.col("a"), F.col("b")
    return _name_pairs(spark, sf_dir).select("a", "b", *(F.round(similarity(n, a, b), 6).alias(n) for n in ("ratio", "token_sort", "token_set")))


@query()
def er_partial_ratio(spark, sf_dir):
    return _name_pairs(spark, sf_dir).withColumn("score", F.round(similarity("partial", F.col("a"), F.col("b")), 6))


@query()
def er_features(spark, sf_dir):
    n = R.norm(spark, sf_dir)
    return features.features(candidates.candidates(n), n, R.truth(spark, sf_dir))


@query(S.w(S.CAND, S.TRUTH) + "SELECT c.s1_id, c.other_id, CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END::TINYINT AS label FROM cand c LEFT JOIN truth t USING (s1_id, other_id)")
def er_label_join(spark, sf_dir):
    return features.labelled(R.rarity_candidates(spark, sf_dir).select("s1_id", "other_id"), R.truth(spark, sf_dir))


@query(S.w(S.CAND) + "SELECT c.s1_id, c.other_id, a.name_core AS q_name_core, o.name_core AS o_name_core, o.source AS o_source FROM cand c JOIN norm a ON a.entity_id = c.s1_id JOIN norm o ON o.entity_id = c.other_id")
def er_enrich_pairs(spark, sf_dir):
    return features.enriched(R.rarity_candidates(spark, sf_dir), R.norm(spark, sf_dir)).select("s1_id", "other_id", "q_name_core", "o_name_core", "o_source")


@query(S.w(S.CAND) + "SELECT s1_id, other_id, count(*) OVER (PARTITION BY other_id) AS n_s1_claiming, rank() OVER (PARTITION BY other_id ORDER BY cheap_score DESC) AS claim_rank FROM cand")
def er_competition(spark, sf_dir):
    return features.competition(R.rarity_candidates(spark, sf_dir)).select("s1_id", "other_id", "n_s1_claiming", F.col("claim_rank").cast("long").alias("claim_rank"))


_RANKS = "SELECT c.s1_id, c.other_id, count(*) OVER w AS n_candidates, rank() OVER (w ORDER BY cheap_score DESC) AS cs_rank, round(cheap_score - max(cheap_score) OVER w, 6) AS cs_gap, rank() OVER (w ORDER BY name_jacc DESC) AS name_rank, rank() OVER (w ORDER BY addr_jacc DESC) AS addr_rank FROM cand c JOIN feat f USING (s1_id, other_id) WINDOW w AS (PARTITION BY c.s1_id)"


@query(S.w(S.CAND, _FEATURES) + _RANKS.replace("(w ORDER", "(PARTITION BY c.s1_id ORDER"))
def er_group_ranks(spark, sf_dir):
    f = _rounded(_native(spark, sf_dir)).select("s1_id", "other_id", F.col("name_jacc").alias("name_tset"), F.col("addr_jacc").alias("addr_tset"))
    df = features.group_features(R.rarity_candidates(spark, sf_dir).join(f, ["s1_id", "other_id"]))
    return df.select("s1_id", "other_id", "n_candidates", F.col("cs_rank").cast("long").alias("cs_rank"), F.round("cs_gap", 6).alias("cs_gap"), F.col("name_tset_rank").cast("long").alias("name_rank"), F.col("addr_tset_rank").cast("long").alias("addr_rank"))


_MEANS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}) FILTER (label = 1), 6) AS mean_match, round(avg({c}) FILTER (label = 0), 6) AS mean_other, count(*) FILTER (isnan({c})) AS n_nan, min({c}) = max({c}) AS constant FROM lab" for c in NATIVE
)


@query(S.w(S.CAND, _FEATURES, S.TRUTH, "lab AS (SELECT f.*, CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END AS label FROM feat f LEFT JOIN truth t USING (s1_id, other_id))") + _MEANS)
def er_label_means(spark, sf_dir):
    return features.label_comparison(features.labelled(_rounded(_native(spark, sf_dir)), R.truth(spark, sf_dir)), NATIVE)


@query(S.w(S.NORM) + f"SELECT token, count(*) AS n, round(ln((SELECT count(*) FROM norm) / count(*)::DOUBLE), 9) AS idf FROM (SELECT unnest(list_distinct({S.words('name_core')})) AS token FROM norm) GROUP BY token")
def er_token_idf(spark, sf_dir):
    return features.token_idf(R.norm(spark, sf_dir))


# Assignment and evaluation


@query(S.w(S.PRED) + "SELECT * FROM pred")
def er_one_to_one(spark, sf_dir):
    return assign.one_to_one(R.rarity_candidates(spark, sf_dir).select("s1_id", "other_id", F.col("cheap_score").alias("prob")))


@query(S.w(S.PRED) + f"SELECT *, prob >= {THRESHOLD} AS kept FROM pred")
def er_baseline_kept(spark, sf_dir):
    return assign.kept(assign.baseline(R.rarity_candidates(spark, sf_dir)), THRESHOLD)


@query(S.w(S.PRED) + "SELECT s1_id, other_id, prob FROM (SELECT *, max(prob) OVER (PARTITION BY s1_id) AS best FROM pred) WHERE prob >= CASE WHEN other_id LIKE 'S2-%' THEN 0.2 ELSE 0.3 END AND best >= 0.4 QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY prob DESC, other_id) <= 2")
def er_capped_matches(spark, sf_dir):
    return assign.capped_matches(R.predictions(spark, sf_dir), {"S2-": 0.2, "S3-": 0.3}, 2, 0.4)


@query(S.w(S.TRUTH) + "SELECT * FROM truth")
def er_truth_pairs(spark, sf_dir):
    return R.truth(spark, sf_dir)


def _lists(spark, sf_dir):
    """The truth as a list for each s1, joined by commas."""
    pairs = R.truth(spark, sf_dir).groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_list("other_id")), ",").alias("l"))
    return R.ids(spark, sf_dir).join(pairs, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce("l", F.lit("")).alias("matched_entity_ids"))


@query(S.w(S.TRUTH) + "SELECT s1_id AS source1_entity_id, coalesce(string_agg(other_id, ',' ORDER BY other_id), '') AS matched_entity_ids FROM ids LEFT JOIN truth USING (s1_id) GROUP BY s1_id")
def er_truth_lists(spark, sf_dir):
    return _lists(spark, sf_dir)


@query(S.w(S.TRUTH) + "SELECT * FROM truth")
def er_truth_exploded(spark, sf_dir):
    lists = _lists(spark, sf_dir)
    pairs = ingest.truth_pairs(lists)
    ingest.check_truth(lists, R.ids(spark, sf_dir).select(F.col("s1_id").alias("entity_id")), pairs)
    return pairs


@query(S.w(S.TRUTH) + "SELECT s1_id, count(other_id)::SMALLINT AS n_matches FROM ids LEFT JOIN truth USING (s1_id) GROUP BY s1_id")
def er_truth_counts(spark, sf_dir):
    lists = _lists(spark, sf_dir)
    return ingest.truth_counts(lists, ingest.truth_pairs(lists))


@query(S.w(S.TRUTH) + "SELECT n_matches, count(*) AS n FROM (SELECT s1_id, count(other_id)::SMALLINT AS n_matches FROM ids LEFT JOIN truth USING (s1_id) GROUP BY s1_id) GROUP BY n_matches ORDER BY n_matches")
def er_match_histogram(spark, sf_dir):
    return er_truth_counts(spark, sf_dir).groupBy("n_matches").agg(F.count("*").alias("n")).orderBy("n_matches")


@query(S.w(S.TRUTH) + "SELECT country, round(avg((n = 0)::INT), 6) AS singleton_rate FROM (SELECT s1_id, country, count(other_id) AS n FROM ids LEFT JOIN truth USING (s1_id) GROUP BY ALL) GROUP BY country")
def er_singletons(spark, sf_dir):
    return er_truth_counts(spark, sf_dir).join(R.ids(spark, sf_dir), "s1_id").groupBy("country").agg(F.round(F.avg((F.col("n_matches") == 0).cast("double")), 6).alias("singleton_rate"))


_ENT = S.w(S.EVAL, f"kp AS (SELECT * FROM pred WHERE prob >= {THRESHOLD})", S.entities("kp"))


def _kept(spark, sf_dir):
    return R.predictions(spark, sf_dir).where(F.col("prob") >= THRESHOLD)


@query(_ENT + "SELECT s1_id, country, tp, n_pred, n_true, round(f05, 9) AS f05 FROM ent")
def er_f05_entities(spark, sf_dir):
    return evaluate.per_entity(_kept(spark, sf_dir), R.truth(spark, sf_dir), R.ids(spark, sf_dir)).withColumn("f05", F.round("f05", 9))


@query(_ENT + "SELECT round(avg(f05), 6) AS macro_f05 FROM ent")
def er_f05_macro(spark, sf_dir):
    return evaluate.macro_f05(_kept(spark, sf_dir), R.truth(spark, sf_dir), R.ids(spark, sf_dir))


@query(_ENT + "SELECT country, round(avg(f05), 6) AS macro_f05 FROM ent GROUP BY country")
def er_f05_by_country(spark, sf_dir):
    return evaluate.f05_by_country(_kept(spark, sf_dir), R.truth(spark, sf_dir), R.ids(spark, sf_dir))


@query(_ENT + f"SELECT {THRESHOLD}::DOUBLE AS threshold, count(*) AS n_s1, round(avg(f05), 6) AS macro_f05, round(sum(tp) / nullif(sum(n_pred), 0)::DOUBLE, 6) AS precision, round(sum(tp) / nullif(sum(n_true), 0)::DOUBLE, 6) AS recall, round(avg(f05) FILTER (n_true = 0), 6) AS macro_f05_singletons, round(avg(f05) FILTER (n_true > 0), 6) AS macro_f05_non_singletons, sum(n_pred)::BIGINT AS n_pred_pairs FROM ent")
def er_prediction_report(spark, sf_dir):
    return evaluate.prediction_report(R.predictions(spark, sf_dir), THRESHOLD, R.truth(spark, sf_dir), R.ids(spark, sf_dir))


_GRID = "grid AS (SELECT unnest([" + ", ".join(f"{t}::DOUBLE" for t in vocab.THRESHOLDS) + "]) AS threshold)"
_CURVE = S.w(S.EVAL, _GRID, "t1 AS (SELECT s1_id, count(*) AS n_true FROM truth GROUP BY 1)", "lp AS (SELECT p.*, (t.s1_id IS NOT NULL)::INT AS hit FROM pred p LEFT JOIN truth t USING (s1_id, other_id))",
    "gp AS (SELECT threshold, s1_id, count(*) AS n_pred, sum(hit) AS tp FROM lp JOIN grid ON prob >= threshold GROUP BY ALL)",
    f"curve AS (SELECT threshold, round(avg({S.f05('tp', 'n_pred', 'n_true')}), 6) AS macro_f05 FROM (SELECT g.threshold, i.s1_id, coalesce(tp, 0) AS tp, coalesce(n_pred, 0) AS n_pred, coalesce(n_true, 0) AS n_true FROM grid g CROSS JOIN ids i LEFT JOIN gp ON gp.threshold = g.threshold AND gp.s1_id = i.s1_id LEFT JOIN t1 ON t1.s1_id = i.s1_id) GROUP BY threshold)")


@query(_CURVE + "SELECT * FROM curve")
def er_threshold_curve(spark, sf_dir):
    return evaluate.threshold_curve(R.predictions(spark, sf_dir), R.truth(spark, sf_dir), R.ids(spark, sf_dir))


@query(_CURVE + "SELECT * FROM curve ORDER BY macro_f05 DESC, threshold LIMIT 1")
def er_best_threshold(spark, sf_dir):
    return evaluate.best_threshold(er_threshold_curve(spark, sf_dir))


_RC = S.w(S.CAND, S.TRUTH, "rk AS (SELECT c.*, t.s1_id IS NOT NULL AS hit, row_number() OVER (PARTITION BY c.s1_id ORDER BY cheap_score DESC, other_id) AS rank FROM cand c LEFT JOIN truth t USING (s1_id, other_id))", "nt AS (SELECT count(*) AS n FROM truth)")


@query(_RC + "SELECT (SELECT n FROM nt) AS n_true_pairs, count(*) AS n_cand_pairs, round(count(*) FILTER (hit) / (SELECT n FROM nt)::DOUBLE, 6) AS recall_all, "
    + ", ".join(f"round(count(*) FILTER (hit AND rank <= {k}) / (SELECT n FROM nt)::DOUBLE, 6) AS recall_at_{k}" for k in vocab.RECALL_KS) + ", "
    + ", ".join(f"count(*) FILTER ((key_hits & {b}) > 0) AS pairs_{k}, round(count(*) FILTER (hit AND (key_hits & {b}) > 0) / (SELECT n FROM nt)::DOUBLE, 6) AS recall_{k}" for k, b in vocab.KEY_BITS.items()) + " FROM rk")
def er_recall(spark, sf_dir):
    return evaluate.recall(R.rarity_candidates(spark, sf_dir), R.truth(spark, sf_dir), R.ids(spark, sf_dir))


@query(_RC + "SELECT country, round(count(c.s1_id) / count(*)::DOUBLE, 6) AS recall FROM truth t JOIN ids USING (s1_id) LEFT JOIN cand c ON c.s1_id = t.s1_id AND c.other_id = t.other_id GROUP BY country")
def er_recall_by_country(spark, sf_dir):
    return evaluate.recall_by_country(R.rarity_candidates(spark, sf_dir), R.truth(spark, sf_dir), R.ids(spark, sf_dir))


@query(_RC + "SELECT round(avg((n = 0)::INT), 6) AS zero_share, round(avg(n), 3) AS mean, quantile_cont(n::DOUBLE, 0.5) AS p50, quantile_cont(n::DOUBLE, 0.95) AS p95, max(n) AS max FROM (SELECT s1_id, count(other_id) AS n FROM ids LEFT JOIN cand USING (s1_id) GROUP BY s1_id)")
def er_pairs_per_s1(spark, sf_dir):
    return evaluate.pairs_per_s1(R.rarity_candidates(spark, sf_dir), R.ids(spark, sf_dir))


@query(S.w(S.CAND, S.TRUTH, "op AS (SELECT s1_id, other_id FROM cand JOIN truth USING (s1_id, other_id))", S.entities("op")) + "SELECT round(avg(f05), 6) AS oracle_macro_f05 FROM ent")
def er_oracle_f05(spark, sf_dir):
    return evaluate.oracle_f05(R.rarity_candidates(spark, sf_dir), R.truth(spark, sf_dir), R.ids(spark, sf_dir))


@query(S.w(S.CAND, S.TRUTH, "best AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY key_weight DESC, other_id) = 1)") + "SELECT * FROM truth t WHERE NOT EXISTS (FROM best c WHERE c.s1_id = t.s1_id AND c.other_id = t.other_id)")
def er_missed_pairs(spark, sf_dir):
    """True pairs that the best candidate of each s1 misses."""
    return candidates.missed_pairs(R.truth(spark, sf_dir), candidates.top(R.rarity_candidates(spark, sf_dir), 1, "key_weight"))


@query(S.w(S.PRED, S.TRUTH) + "SELECT s1_id, other_id FROM truth EXCEPT SELECT s1_id, other_id FROM (SELECT * FROM pred QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY prob DESC, other_id) = 1)")
def er_matches_outside_candidates(spark, sf_dir):
    """True pairs that are not among the best predictions of each s1."""
    return validate.outside(R.truth(spark, sf_dir), candidates.top(R.predictions(spark, sf_dir), 1, "prob"))


@query("SELECT DISTINCT 'S' || (1 + doc_id % 3) || '-' || doc_id AS s1_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def er_unknown_ids(spark, sf_dir):
    source = (F.pmod(F.col("doc_id"), F.lit(3)) + 1).cast("string")
    name = F.concat(F.lit("S"), source, F.lit("-"), F.col("doc_id").cast("string")).alias("s1_id")
    some = spark.read.parquet(f"{sf_dir}/labels.parquet").select(name)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(name).distinct().join(some, "s1_id", "left_anti")


# Aliases, with low thresholds

_ALIAS = S.w(S.NORM, S.TRUTH, """tp AS (SELECT a.country, a.parts[greatest(len(a.parts) - 1, 1):len(a.parts)] AS t1, o.parts[greatest(len(o.parts) - 1, 1):len(o.parts)] AS t2 FROM truth JOIN n1 a ON a.entity_id = s1_id JOIN n1 o ON o.entity_id = other_id)""",
    "s1c AS (SELECT place, count(*) FILTER (place = l) AS s1_last, count(*) AS s1_any FROM (SELECT unnest(list_distinct(t1)) AS place, t1[-1] AS l FROM tp) GROUP BY place)",
    "oc AS (SELECT place AS variant, count(*) FILTER (place = l) AS other_last, count(*) AS occ FROM (SELECT unnest(list_distinct(t2)) AS place, t2[-1] AS l FROM tp) GROUP BY place)",
    "co AS (SELECT variant, canonical, country, count(*) AS n FROM (SELECT country, variant, unnest(list_distinct(t1)) AS canonical FROM (SELECT country, t1, unnest(list_filter(list_distinct(t2), lambda x: NOT list_contains(t1, x))) AS variant FROM tp)) GROUP BY ALL)",
    "canon AS (SELECT place AS canonical, s1_last FROM s1c WHERE s1_last >= 2 AND s1_last / s1_any::DOUBLE >= 0.5)", "city AS (SELECT place FROM s1c WHERE s1_any >= 2 AND s1_last / s1_any::DOUBLE < 0.5)",
    "tot AS (SELECT variant, canonical, sum(n)::BIGINT AS count, max_by(country, lpad(n::VARCHAR, 12, '0') || country) AS country FROM co GROUP BY ALL)")


def _pairs(spark, sf_dir):
    return aliases.sample_pairs(R.truth(spark, sf_dir), R.records(spark, sf_dir))


@query(_ALIAS + "SELECT place, s1_last, s1_any FROM s1c")
def er_alias_counts(spark, sf_dir):
    return aliases.counts(_pairs(spark, sf_dir))[0]


@query(_ALIAS + "SELECT variant, canonical, country, n FROM co")
def er_alias_cooccurrence(spark, sf_dir):
    return aliases.counts(_pairs(spark, sf_dir))[2]


@query(_ALIAS + """SELECT variant, canonical, count, occ AS occurrences, country FROM (SELECT * FROM tot JOIN oc USING (variant) WHERE canonical IN (SELECT canonical FROM canon) AND variant NOT IN (SELECT canonical FROM canon) AND variant NOT IN (SELECT place FROM city)
  AND other_last / occ::DOUBLE >= 0.5 AND count >= 2 AND count >= 0.3 * occ QUALIFY row_number() OVER (PARTITION BY variant ORDER BY count DESC, canonical) = 1)
  UNION ALL SELECT canonical, canonical, s1_last, s1_last, '' FROM canon""")
def er_alias_learned(spark, sf_dir):
    return aliases.learn(_pairs(spark, sf_dir), 2, 0.3, 0.5)


# Splits, sinks, sources, validation


@query(S.w(S.TRUTH) + f"SELECT s1_id, CASE WHEN {S.crc32('s1_id' + " || '#fold'")} % {vocab.VAL_MOD} = 0 THEN 'val' ELSE 'fit' END AS fold, ({S.crc32('s1_id')} % {vocab.N_SHARDS})::SMALLINT AS shard FROM ids")
def er_splits(spark, sf_dir):
    return splits.splits(R.ids(spark, sf_dir), "s1_id")


@query()
def er_sample(spark, sf_dir):
    return splits.seeded_sample(R.truth(spark, sf_dir), 10, "s1_id", "other_id")


@query(S.w(S.PRED, S.TRUTH) + "SELECT s1_id, s1_id || chr(9) || coalesce(string_agg(other_id, ',' ORDER BY prob DESC, other_id), '') AS line FROM ids LEFT JOIN pred USING (s1_id) GROUP BY s1_id")
def er_id_lists(spark, sf_dir):
    ids = readers.ordered_ids(R.ids(spark, sf_dir), "s1_id")
    return writers.id_lists(ids, R.predictions(spark, sf_dir), [F.desc("prob")]).select("s1_id", "line")


@query(S.w(S.PRED, S.TRUTH) + "SELECT 'source1_entity_id' || chr(9) || 'matched_entity_ids' AS value UNION ALL SELECT s1_id || chr(9) || coalesce(string_agg(other_id, ',' ORDER BY other_id), '') FROM ids LEFT JOIN pred USING (s1_id) GROUP BY s1_id")
def er_id_list_file(spark, sf_dir):
    path = scratch(spark, "lists") + "/matching_results.tsv"
    writers.write_id_lists(readers.ordered_ids(R.ids(spark, sf_dir), "s1_id"), R.predictions(spark, sf_dir), path, "matched_entity_ids")
    return spark.read.text(path)


def _bad_lines(spark, sf_dir):
    """Lists with every kind of fault: lines from documents, whose ids follow from doc_id."""
    d = F.col("doc_id")
    s1 = F.concat(F.lit("S1-"), (d - F.pmod(d, F.lit(7)).cast("long") % 2).cast("string"))
    ids = F.concat_ws(",", F.concat(F.lit("S2-"), d.cast("string")), F.when(d % 5 == 0, F.concat(F.lit("S1-"), d.cast("string"))), F.when(d % 11 == 0, F.concat(F.lit("X-"), d.cast("string"))), F.when(d % 13 == 0, F.concat(F.lit("S2-"), d.cast("string"))))
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.concat_ws("\t", s1, F.when(d % 17 == 0, F.lit("")).otherwise(ids)).alias("value"))


_BAD = """bad AS (SELECT 'S1-' || (doc_id - (doc_id % 7) % 2) AS s1_id, CASE WHEN doc_id % 17 = 0 THEN [] ELSE list_filter(['S2-' || doc_id, CASE WHEN doc_id % 5 = 0 THEN 'S1-' || doc_id END, CASE WHEN doc_id % 11 = 0 THEN 'X-' || doc_id END, CASE WHEN doc_id % 13 = 0 THEN 'S2-' || doc_id END], lambda x: x IS NOT NULL) END AS ids FROM documents),
each AS (SELECT DISTINCT unnest(ids) AS id FROM bad), need AS (SELECT DISTINCT 'S1-' || doc_id AS id FROM labels), target AS (SELECT DISTINCT 'S2-' || doc_id AS id FROM labels),
iss AS (SELECT 'duplicate_row' AS rule, s1_id AS id FROM bad GROUP BY s1_id HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'repeated_id', s1_id FROM bad WHERE len(ids) > len(list_distinct(ids))
 UNION ALL SELECT 'self_match', id FROM each WHERE id LIKE 'S1-%' UNION ALL SELECT 'bad_prefix', id FROM each WHERE id LIKE 'X-%' UNION ALL SELECT 'missing', id FROM need WHERE id NOT IN (SELECT s1_id FROM bad)
 UNION ALL SELECT DISTINCT 'unexpected', s1_id FROM bad WHERE s1_id NOT IN (SELECT id FROM need) UNION ALL SELECT 'unknown_id', id FROM each WHERE id LIKE 'S2-%' AND id NOT IN (SELECT id FROM target))"""


def _issues(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    need, target = (labels.select(F.concat(F.lit(p), F.col("doc_id").cast("string")).alias("id")) for p in ("S1-", "S2-"))
    return validate.issues(validate.parsed(_bad_lines(spark, sf_dir)), need, target)


@query(f"WITH {_BAD} SELECT * FROM iss")
def er_validator_issues(spark, sf_dir):
    return _issues(spark, sf_dir)


@query(f"WITH {_BAD} SELECT rule, count(*) AS total, array_to_string((list(id ORDER BY id))[1:5], ', ') AS examples FROM iss GROUP BY rule")
def er_validator_summary(spark, sf_dir):
    return validate.summary(_issues(spark, sf_dir))


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_mktsegment FROM customer")
def src_tsv(spark, sf_dir):
    """Customers written as tab-separated text and scanned again, all values text."""
    path, names = scratch(spark, "tsv"), ("c_custkey", "c_name", "c_mktsegment")
    spark.read.parquet(f"{sf_dir}/customer.parquet").select(*(F.col(c).cast("string") for c in names)).write.csv(path, sep="\t", header=True, quote="", escape="", emptyValue="")
    return readers.read_tsv(spark, path, names)


@query("SELECT DISTINCT r_name AS id FROM region")
def src_first_column(spark, sf_dir):
    path = scratch(spark, "ids") + "/ids.tsv"
    rows = [r.r_name for r in spark.read.parquet(f"{sf_dir}/region.parquet").select("r_name").collect()]
    writers.write_text(spark, path, "name\tother\n" + "".join(f" {r} \tx\n\n" for r in rows))
    return readers.first_column_ids(spark, path)


@query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_totalprice > 100000")
def src_parquet_pushdown(spark, sf_dir):
    return readers.read_parquet(spark, f"{sf_dir}/orders.parquet", columns=["o_orderkey", "o_totalprice", "o_orderdate"], where="o_totalprice > 100000")


@query("SELECT n_nationkey AS k, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region")
def src_multi_file(spark, sf_dir):
    path = scratch(spark, "multi")
    for name, k in (("nation", "n"), ("region", "r")):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").select(F.col(f"{k}_{name}key").alias("k"), F.col(f"{k}_name").alias("name")).write.parquet(f"{path}/{name}")
    return readers.read_parquet(spark, f"{path}/nation", f"{path}/region")


@query(S.w(S.CAND) + "SELECT s1_id, other_id, length(s1_id) % 4 AS shard FROM cand WHERE length(s1_id) % 4 IN (1, 2)")
def src_shards(spark, sf_dir):
    path = scratch(spark, "shards")
    rows = R.rarity_candidates(spark, sf_dir).select("s1_id", "other_id", (F.length("s1_id") % 4).alias("shard"))
    writers.write_parquet(rows, path, partition_by="shard")
    return readers.read_shards(spark, path, [1, 2])
