"""Features, splits, files, validation, the stages, streaming and the queries against SQL."""

import math
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from linkmill.functions import vocab
from linkmill.operators import candidates, features, ingest, splits, validate
from linkmill.operators.normalize import normalize
from linkmill.plans import queries as Q
from linkmill.plans.pipeline import Run
from linkmill.sources import readers, writers
from linkmill.streaming import incremental

RECORD = "entity_id string, source int, country string, business_name string, business_address string"
DATA = "/root/testdata/sf0.001"


def test_features(spark):
    base = {"name_norm": "kochar gold", "name_core": "kochar gold", "name_nospace": "kochargold", "name_has_url": 0, "name_nonlatin": 0, "addr_norm": "12 main road pune mh",
            "addr_core": "12 main road pune", "addr_nums": "12", "addr_first_num": "12", "addr_admin": "maharashtra"}
    others = [{**base, "source": 2}, {**base, "source": 3, "name_core": "gold traders", "addr_norm": "", "addr_core": "", "addr_nums": "", "addr_first_num": "", "addr_admin": "", "name_has_url": 1},
              {**base, "source": 2, "addr_nums": "99 12", "addr_first_num": "99", "addr_admin": "delhi"}]
    norm = spark.createDataFrame([("S1-1", "IN", {**base, "source": 1})] + [(f"S{o['source']}-{i}", "IN", o) for i, o in enumerate(others)], "entity_id string, country string, m map<string,string>")
    norm = norm.select("entity_id", "country", *(F.col("m")[k].cast("int" if k in ("source", "name_has_url", "name_nonlatin") else "string").alias(k) for k in (*base, "source")))
    cand = spark.createDataFrame([("S1-1", f"S{o['source']}-{i}", 9, s, 1.0) for i, (o, s) in enumerate(zip(others, (0.9, 0.3, 0.6), strict=True))], "s1_id string, other_id string, key_hits int, cheap_score double, key_weight double")
    truth = spark.createDataFrame([("S1-1", "S2-0")], "s1_id string, other_id string")
    got = {r.other_id: r for r in features.features(cand, norm, truth).collect()}
    a, b, c = got["S2-0"], got["S3-1"], got["S2-2"]
    assert (a.name_tset, a.addr_tset, a.first_num_eq, a.num_jacc, a.admin_eq, a.name_jacc, a.label) == (100, 100, 1, 1, 1, 1, 1)
    assert {b[x] for x in ("addr_tset", "addr_partial", "addrnorm_tsort", "addr_jacc", "num_jacc", "first_num_eq", "admin_eq")} == {-1}
    assert (b.other_addr_empty, b.s1_num_share, b.other_name_has_url, b.other_source) == (1, 0, 1, 3)
    assert (c.first_num_eq, c.num_jacc, c.admin_eq, c.s1_num_share) == (0, 0.5, 0, 1)
    for r in got.values():
        assert (r.key_k1, r.key_k2, r.key_k3, r.key_k4, r.n_candidates) == (1, 0, 0, 1, 3)
        assert not any(math.isnan(r[f]) for f in features.FEATURES)
    assert [r.cs_rank for r in (a, b, c)] == [1, 3, 2] and [round(r.cs_gap, 6) for r in (a, b, c)] == [0, -0.6, -0.3]
    assert len(set(features.FEATURES)) == 36 and not any("country" in f for f in features.FEATURES)


def test_keys_and_caps(spark):
    rows = [("S1-1", 1, "US", "Alpha Beta Gamma", "12 Main Street Springfield"), ("S2-1", 2, "US", "Alpha Beta", "012 Main St, Springfield"), ("S3-1", 3, "US", "alpha beta", "Springfield Main"), ("S2-2", 2, "IN", "Alpha Beta", "12 Main St")]
    norm = normalize(spark.createDataFrame(rows, RECORD))
    keys = {(r.entity_id, r.bit, r.key) for r in candidates.keys(norm).collect()}
    assert {("S1-1", 1, "12|alpha"), ("S1-1", 2, "12|main"), ("S1-1", 4, "alpha|springfield"), ("S1-1", 8, "alphabet"), ("S3-1", 8, "alphabet")} <= keys
    assert not any(e == "S3-1" and b in (1, 2) for e, b, _ in keys)
    found = {(r.s1_id, r.other_id): r.key_hits for r in candidates.pairs(candidates.capped_keys(candidates.keys(norm), 10)).collect()}
    assert found == {("S1-1", "S2-1"): 15, ("S1-1", "S3-1"): 12}
    assert candidates.pairs(candidates.capped_keys(candidates.keys(norm), 1)).where("other_id = 'S3-1'").count() == 0
    scored = {r.other_id: r.cheap_score for r in candidates.candidates(norm, 10).collect()}
    assert scored["S2-1"] == 1.0 and 0.5 < scored["S3-1"] < 1
    shuffled = candidates.candidates(normalize(spark.createDataFrame(rows[::-1], RECORD)), 10)
    assert sorted(map(str, shuffled.collect())) == sorted(map(str, candidates.candidates(norm, 10).collect()))


def test_splits(spark):
    ids = ["S1-925783039", "S1-773889195", "S1-714132312", "S1-106407869", "S1-x"]
    for r in splits.splits(spark.createDataFrame([(x,) for x in ids], "entity_id string")).collect():
        assert r.shard == zlib.crc32(r.s1_id.encode()) % 16
        assert r.fold == ("val" if zlib.crc32(f"{r.s1_id}#fold".encode()) % 5 == 0 else "fit")
    assert spark.sql("SELECT crc32('abc')").first()[0] == 891568578


def test_tsv_keeps_text(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-a\tnull\t\t"x\\ # NA\n\nS1-b\tNA\té\tUS\n', encoding="utf-8")
    got = [tuple(r) for r in readers.read_tsv(spark, str(tmp_path / "a.tsv")).collect()]
    assert got == [("S1-a", "null", "", '"x\\ # NA'), ("S1-b", "NA", "é", "US")]
    with pytest.raises(ValueError):
        readers.read_tsv(spark, str(tmp_path / "a.tsv"), ("x", "y"))
    assert readers.read_tsv(spark, str(tmp_path / "a.tsv"), limit=1).count() == 1


def test_id_lists_are_exact(spark, tmp_path):
    ids = spark.createDataFrame([("S1-b", 0), ("S1-a", 1), ("S1-x", 2)], "s1_id string, ord long")
    pairs = spark.createDataFrame([("S1-a", "S3-2", 1), ("S1-a", "S2-1", 2), ("S1-a", "S3-2", 3), ("S1-b", "S1-z", 1), ("S1-b", "S2-1", 2), ("S1-b", "X-3", 3), ("S1-b", "", 4)], "s1_id string, other_id string, p int")
    writers.write_id_lists(ids, pairs, str(tmp_path / "o.tsv"), "matched_entity_ids", [F.col("p")])
    assert (tmp_path / "o.tsv").read_bytes() == b"source1_entity_id\tmatched_entity_ids\nS1-b\tS2-1\nS1-a\tS3-2,S2-1\nS1-x\t\n"


@pytest.mark.parametrize(
    "text,rule",
    [("S1-a\tS2-1,S2-1\nS1-b\t\nS1-c\t\n", "repeated_id"), ("S1-a\t\nS1-b\t\n", "missing"), ("S1-a\tS1-b\nS1-b\t\nS1-c\t\n", "self_match"), ("S1-a\t\nS1-a\t\nS1-b\t\nS1-c\t\n", "duplicate_row"),
     ("S1-a\tQ\nS1-b\t\nS1-c\t\nS1-d\t\n", "bad_prefix"), ("S1-a\t\nS1-b\t\nS1-c\t\nno tab\n", "without a tab"), ("S1-a\tS2-1\nS1-b\t\nS1-c\t\n", None)],
)
def test_validator(spark, tmp_path, text, rule):
    (tmp_path / "s1.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join(f"S1-{x}\t\t\t\n" for x in "abc"))
    (tmp_path / "m.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + text)
    errors, warnings = validate.validate(spark, str(tmp_path / "m.tsv"), str(tmp_path / "none.tsv"), str(tmp_path / "s1.tsv"))
    assert (not errors) if rule is None else any(rule in e for e in errors)
    assert len(warnings) == 2
    (tmp_path / "m.tsv").write_text("source1_entity_id,matched_entity_ids\n" + text)
    assert "tab-separated" in validate.validate(spark, str(tmp_path / "m.tsv"), None, str(tmp_path / "s1.tsv"))[0][0]


def test_writer_checks(spark):
    pair = "s1_id string, other_id string"
    with pytest.raises(ValueError, match="S1-a"):
        validate.check_matches_in_candidates(spark.createDataFrame([("S1-a", "S3-9")], pair), spark.createDataFrame([("S1-a", "S3-1")], pair))
    with pytest.raises(ValueError, match="S1-zzz"):
        validate.check_known(spark.createDataFrame([("S1-zzz", "S3-9")], pair), spark.createDataFrame([("S1-a",)], "s1_id string"))
    with pytest.raises(ingest.InvariantError):
        ingest.check_unique(spark.createDataFrame([("a",), ("a",)], "x string"), "x")


def corpus(folder, seed):
    """Three noisy sources and their truth."""
    random.seed(seed)
    names, streets = ["Alpha", "Bravo", "Coral", "Delta", "Ember", "Falcon", "Garnet", "Harbor"], ["Main", "Oak", "Pine", "Cedar", "Lake", "Hill"]
    for split in ("train", "test"):
        (folder / split).mkdir(parents=True)
        sources, truth = {1: [], 2: [], 3: []}, []
        for i in range(60):
            name, street, country = " ".join(random.sample(names, 2)), f"{random.randint(1, 99)} {random.choice(streets)}", random.choice(["US", "India"])
            sources[1].append((f"S1-{i}", f"{name} Inc", f"{street} Street, Springfield, TX", country))
            match = []
            for k in (2, 3):
                if random.random() < 0.7:
                    sources[k].append((f"S{k}-{i}", f"{name.upper()} {random.choice(['', 'LLC', 'Co.'])}".strip(), f"{street} St, Springfield, Texas", country))
                    match.append(f"S{k}-{i}")
            truth.append((f"S1-{i}", ",".join(match)))
        for k, rows in sources.items():
            (folder / split / f"{split}_source{k}.tsv").write_text("\t".join(readers.RECORD) + "\n" + "".join("\t".join(r) + "\n" for r in rows))
        if split == "train":
            (folder / split / "train_ground_truth.tsv").write_text("\t".join(readers.TRUTH) + "\n" + "".join("\t".join(r) + "\n" for r in truth))


def test_stages_end_to_end(spark, tmp_path):
    corpus(tmp_path / "data", 5)
    run = Run(spark, str(tmp_path / "data"), str(tmp_path / "work"))
    took = run.all(min_count=10)
    assert set(took) >= {"ingest", "splits", "aliases", "blocking_train", "features_test", "baseline_test", "output"}
    assert run.aliases()["admin"] == {"tx": "tx", "texas": "tx"}
    report = readers.read_json(spark, f"{run.work}/reports/baseline_val.json")
    assert report["macro_f05"] > 0.8 and report["macro_f05"] >= report["macro_f05_without_one_to_one"] - 1e-9
    blocking = readers.read_json(spark, f"{run.work}/reports/blocking_train.json")
    assert blocking["cross_country_pairs"] == 0 and blocking["candidates"]["recall_all"] == 1.0
    assert run.output()[0] == [] and run.output("dry-run")[0] == []
    lines = spark.read.text(f"{run.work}/output/candidate_pairs.tsv").collect()
    assert [r.value.split("\t")[0] for r in lines[1:]] == [f"S1-{i}" for i in range(60)]
    assert run.write(run.read("splits"), "splits") is False  # finished stages are kept
    trained = run.train(rounds=5, depth=3)
    assert trained["macro_f05"] > 0.8 and len(trained["importances"]) == 20
    assert run.predict()["pairs"] > 0 and run.output("model")[0] == []


def test_stream_equals_batch(spark, tmp_path):
    rows = [(f"S1-{i}", 1, "US", f"Alpha{i % 5} Beta", f"{i} Main Street Springfield") for i in range(20)] + [(f"S2-{i}", 2, "US", f"Alpha{i % 5} Beta", f"{i} Main St Springfield") for i in range(20)]
    records = spark.createDataFrame(rows, RECORD)
    norm = normalize(records).cache()
    index = incremental.index_keys(norm).cache()
    records.where("source = 1").drop("source").repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("entity_id string, country string, business_name string, business_address string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = incremental.match_stream(stream, index, norm, str(tmp_path / "out"), str(tmp_path / "ck"))
    query.processAllAvailable()
    query.stop()
    got = {(r.s1_id, r.other_id, r.cheap_score) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(r.s1_id, r.other_id, r.cheap_score) for r in candidates.candidates(norm).collect()}
    assert got == want


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the shared tables")
def test_queries_against_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer part orders documents labels".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    plain = lambda v: None if v is None or v != v else round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    for name in ("er_norm", "er_keys_all", "er_candidates", "er_native_features", "er_threshold_curve", "er_prediction_report", "er_recall", "er_alias_learned", "er_id_list_file", "er_similarities", "er_scored_candidates", "er_splits", "er_missed_pairs", "er_matches_outside_candidates", "er_validator_summary", "er_norm_shares"):
        df = Q.queries()[name](spark, DATA)
        columns = sorted(df.columns)
        got = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
        want = con.execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({Q.oracle_sql()[name]})").fetchall()
        assert got == sorted(str([plain(v) for v in r]) for r in want), name


def test_queries_run_at_the_limits_of_the_library(spark, tmp_path):
    docs = [(i, "alpha bravo charlie delta echo foxtrot golf hotel", "en", "s", 50) for i in range(600)]  # 200 queries, a group of 400 others
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    per_s1 = lambda name: {r["count"] for r in Q.queries()[name](spark, str(tmp_path)).groupBy("s1_id").count().collect()}
    assert per_s1("er_scored_candidates") == per_s1("er_features") == {vocab.TOP_K}
    assert per_s1("er_candidates") == per_s1("er_native_features") == {vocab.PREFILTER_K}
    assert per_s1("er_pairs_key_hits") == {400}
    assert Q.queries()["er_recall"](spark, str(tmp_path)).first().n_cand_pairs == 200 * vocab.PREFILTER_K
    assert Q.queries()["er_keys_capped"](spark, str(tmp_path)).where("n_index = 400").count() > 0


def test_tight_caps_drop_groups(spark, tmp_path):
    docs = [(i, f"alpha bravo charlie delta {'echo' if i < 9 else f'name{i}'} foxtrot golf hotel", "en", "s", 50) for i in range(30)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    norm = Q.R.norm(spark, str(tmp_path))
    kept = candidates.capped_keys(candidates.keys(norm), 6)
    assert 0 < kept.count() < candidates.capped_keys(candidates.keys(norm)).count()
    assert kept.agg({"n_index": "max"}).first()[0] <= 6
    assert {r["count"] for r in candidates.top(candidates.pairs(kept), 2, "key_weight").groupBy("s1_id").count().collect()} == {2}


def test_plans_stay_in_the_jvm(spark):
    plan = Q.queries()["er_candidates"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "WindowGroupLimit" in plan
    scan = Q.queries()["src_parquet_pushdown"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,100000.0)" in scan and "o_custkey" not in scan
    assert vocab.THRESHOLDS[0] == 0.05 and len(vocab.THRESHOLDS) == 91
