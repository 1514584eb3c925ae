import random

import pytest
from pyspark.sql import functions as F

from linkmill.functions import vocab
from linkmill.operators import evaluate as E
from linkmill.operators.assign import capped_matches, kept, one_to_one

PAIR = "s1_id string, other_id string"
TRUTH = [("A", "S2-1"), ("A", "S3-1"), ("B", "S2-2"), ("E", "S2-5"), ("E", "S3-5")]
PRED = [("A", "S2-1", 0.9), ("A", "S3-1", 0.8), ("A", "S2-9", 0.7), ("B", "S2-2", 0.6), ("C", "S2-3", 0.3), ("D", "S3-4", 0.9), ("E", "S2-5", 0.95), ("E", "S3-6", 0.55)]


@pytest.fixture(scope="module")
def world(spark):
    ids = spark.createDataFrame([(x, "US" if x in "ABC" else "India") for x in "ABCDE"], "s1_id string, country string")
    return spark.createDataFrame(PRED, f"{PAIR}, prob double"), spark.createDataFrame(TRUTH, PAIR), ids


def test_report(world):
    pred, truth, ids = world
    r = E.prediction_report(pred, 0.5, truth, ids).first()
    assert (r.macro_f05, r.n_s1, r.n_pred_pairs) == (0.642857, 5, 7)
    assert (r.precision, r.recall, r.macro_f05_singletons, r.macro_f05_non_singletons) == (round(4 / 7, 6), 0.8, 0.5, 0.738095)
    by = {r.country: r.macro_f05 for r in E.f05_by_country(pred.where("prob >= 0.5"), truth, ids).collect()}
    assert by == {"US": 0.904762, "India": 0.25}
    only = E.macro_f05(pred.where("s1_id = 'A'"), truth, ids).first()[0]
    assert only == round((5 / 7 + 0 + 1 + 1 + 0) / 5, 6)


def test_best_threshold(world):
    best = E.best_threshold(E.threshold_curve(*world)).first()
    assert (best.threshold, best.macro_f05) == (0.56, round((5 / 7 + 1 + 1 + 0 + 5 / 6) / 5, 6))


def test_curve_is_the_evaluator(spark):
    random.seed(0)
    truth = [(f"S1-{i}", f"S2-{i}-{j}") for i in range(120) for j in range(random.randint(0, 3))]
    pred = [(s, o, round(random.random(), 2)) for s, o in truth if random.random() < 0.7] + [(f"S1-{random.randrange(130)}", f"S3-{k}", round(random.random(), 2)) for k in range(200)]
    ids = spark.createDataFrame([(f"S1-{i}", "x") for i in range(120)], "s1_id string, country string")
    p, t = spark.createDataFrame(pred, f"{PAIR}, prob double").cache(), spark.createDataFrame(truth, PAIR).cache()
    curve = {r.threshold: r.macro_f05 for r in E.threshold_curve(p, t, ids).collect()}
    assert len(curve) == 91
    for threshold in vocab.THRESHOLDS[::15]:
        assert abs(curve[threshold] - E.macro_f05(p.where(F.col("prob") >= threshold).join(ids, "s1_id", "left_semi"), t, ids).first()[0]) < 2e-6


def test_formula(spark):
    rows = [(tp, p, t) for p in range(4) for t in range(4) for tp in range(min(p, t) + 1)]
    df = spark.createDataFrame(rows, "tp int, p int, t int")
    for r in df.withColumn("f", E.f05(F.col("tp"), F.col("p"), F.col("t"))).collect():
        want = (1.0 if r.p == 0 else 0.0) if r.t == 0 else 0.0 if r.tp == 0 else 1.25 * (r.tp / r.p) * (r.tp / r.t) / (0.25 * r.tp / r.p + r.tp / r.t)
        assert abs(r.f - want) < 1e-12
    assert round(df.where("tp = 2 and p = 3 and t = 2").select(E.f05(F.col("tp"), F.col("p"), F.col("t"))).first()[0], 3) == 0.714
    assert E.macro_f05(df.limit(0).select(F.lit("a").alias("s1_id"), F.lit("b").alias("other_id")), df.limit(0).select(F.lit("a").alias("s1_id"), F.lit("b").alias("other_id")), df.limit(0).select(F.lit("a").alias("s1_id"))).first()[0] is None


def test_candidate_statistics(spark, world):
    _, truth, ids = world
    rows = [("A", "S2-1", 1, 0.9), ("A", "S2-9", 2, 0.8), ("A", "S3-1", 3, 0.1), ("B", "S2-2", 2, 0.5), ("D", "S3-4", 1, 0.7), ("E", "S2-5", 1, 0.6), ("Z", "S2-1", 1, 0.9)]
    cand = spark.createDataFrame(rows, f"{PAIR}, key_hits int, cheap_score double")
    r = E.recall(cand, truth, ids).first()
    assert (r.n_cand_pairs, r.n_true_pairs, r.recall_all, r.recall_K1, r.recall_K2, r.recall_K4, r.recall_at_10) == (6, 5, 0.8, 0.6, 0.4, 0.0, 0.8)
    assert {x.country: x.recall for x in E.recall_by_country(cand, truth, ids).collect()} == {"US": 1.0, "India": 0.5}
    n = E.pairs_per_s1(cand, ids).first()
    assert (n.zero_share, n["max"], n["mean"]) == (0.2, 3, 1.2)
    assert E.oracle_f05(cand, truth, ids).first()[0] == round((4 + 5 / 6) / 5, 6)


def test_one_to_one(spark):
    rows = [("a", "S2-1", 0.4), ("b", "S2-1", 0.9), ("c", "S2-1", 0.9), ("a", "S3-2", 0.7), ("b", "S3-2", 0.2)]
    df = spark.createDataFrame(rows, f"{PAIR}, prob double")
    assert sorted((r.s1_id, r.other_id) for r in one_to_one(df).collect()) == [("a", "S3-2"), ("b", "S2-1")]
    assert kept(df, 0.7).where("kept").count() == 3
    assert sorted(tuple(r) for r in capped_matches(df, {"S2-": 0.5, "S3-": 0.1}, 1, 0.8).collect()) == [("b", "S2-1", 0.9), ("c", "S2-1", 0.9)]
