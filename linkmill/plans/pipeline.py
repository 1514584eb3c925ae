"""Stages from files to files, and a command line: python -m linkmill STAGE [options].

Layout of a work folder: raw/{split}_s{k}, gt_pairs, gt_s1, splits, test_shards, aliases.json, norm/{split}, cand/{split},
feat/{split}, pred/{split}, output/*.tsv, reports/*.json. A finished stage is skipped unless forced."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.functions import vocab
from linkmill.operators import aliases, assign, candidates, evaluate, features, ingest, normalize, splits, validate
from linkmill.sources import readers, writers

STAGES = ("ingest", "splits", "aliases", "normalize", "blocking", "features", "baseline", "evaluate", "train", "predict", "write", "validate")


class Run:
    """One work folder on one session."""

    def __init__(self, spark: SparkSession, data: str, work: str, force: bool = False):
        self.spark, self.data, self.work, self.force = spark, data.rstrip("/"), work.rstrip("/"), force

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.work}/{name}")

    def write(self, df: DataFrame, name: str, **options) -> bool:
        return writers.write_parquet(df, f"{self.work}/{name}", self.force, **options)

    def report(self, name: str, content: dict) -> dict:
        writers.write_json(self.spark, f"{self.work}/reports/{name}.json", content)
        return content

    def has(self, name: str) -> bool:
        return writers.exists(self.spark, f"{self.work}/{name}")

    def ingest(self, expected: dict[str, int] | None = None) -> dict:
        rows, expected = {}, expected or {}
        for split in ("train", "test"):
            for k in (1, 2, 3):
                name = f"{split}_source{k}.tsv"
                raw = readers.read_tsv(self.spark, f"{self.data}/{split}/{name}").withColumn("ord", F.monotonically_increasing_id())
                self.write(ingest.source_table(raw, k, expected.get(name)), f"raw/{split}_s{k}")
                rows[name] = self.read(f"raw/{split}_s{k}").count()
        truth = readers.read_tsv(self.spark, f"{self.data}/train/train_ground_truth.tsv", readers.TRUTH)
        pairs = ingest.truth_pairs(truth)
        ingest.check_truth(truth, self.read("raw/train_s1"), pairs)
        self.write(pairs, "gt_pairs")
        self.write(ingest.truth_counts(truth, pairs), "gt_s1")
        return self.report("ingest", {"rows": rows, **ingest.truth_report(self.read("gt_pairs"), self.read("gt_s1"))})

    def splits(self) -> dict:
        self.write(splits.splits(self.read("raw/train_s1")), "splits")
        self.write(self.read("raw/test_s1").select(F.col("entity_id").alias("s1_id"), splits.shard_of(F.col("entity_id")).alias("shard")), "test_shards")
        sizes = {r.shard: r["count"] for r in self.read("test_shards").groupBy("shard").count().orderBy("shard").collect()}
        return self.report("splits", {**splits.split_report(self.read("splits"), self.read("gt_s1")), "n_test": sum(sizes.values()), "shard_sizes_test": sizes})

    def raw(self, split: str) -> DataFrame:
        return readers.read_parquet(self.spark, *(f"{self.work}/raw/{split}_s{k}" for k in (1, 2, 3))).drop("ord")

    def aliases(self, **options) -> dict:
        path = f"{self.work}/aliases.json"
        if writers.exists(self.spark, path) and not self.force:
            return readers.read_json(self.spark, path)
        learned = aliases.learn(aliases.sample_pairs(self.read("gt_pairs"), self.raw("train")), **options).persist()
        table = {"admin": aliases.as_dict(learned)}
        writers.write_json(self.spark, path, table)
        rows = learned.collect()  # as many as there are regions and their spellings
        checks = [f"{r.variant} -> {r.canonical}: {'learned' if r.ok else 'not learned'}" for r in aliases.sanity(learned).collect()]
        mappings = [r.asDict() for r in rows if r.variant != r.canonical]
        canonicals = sorted(((r.canonical, r["count"]) for r in rows if r.variant == r.canonical), key=lambda x: (-x[1], x[0]))
        writers.write_text(self.spark, f"{self.work}/reports/aliases.md", writers.alias_markdown(mappings, canonicals, checks))
        learned.unpersist()
        return table

    def normalize(self, split: str, limit: int | None = None) -> dict:
        table = readers.read_json(self.spark, f"{self.work}/aliases.json")["admin"] if writers.exists(self.spark, f"{self.work}/aliases.json") else {}
        raw = self.raw(split)
        name = f"norm/{split}" if limit is None else f"norm_limit/{split}"
        self.write(normalize.normalize(raw if limit is None else raw.limit(limit), table), name)
        return self.report(f"normalize_{split}", {"shares": [r.asDict() for r in normalize.shares(self.read(name), "source", "country").collect()]})

    def ids(self, split: str, shards: list[int] | None = None) -> DataFrame:
        df = self.read("splits" if split == "train" else "test_shards")
        return df if shards is None else df.where(F.col("shard").isin(shards))

    def blocking(self, split: str, shards: list[int] | None = None, cap: int = vocab.BLOCK_CAP, prefilter_k: int = vocab.PREFILTER_K, top_k: int = vocab.TOP_K) -> dict:
        norm, ids = self.read(f"norm/{split}"), self.ids(split, shards)
        found = candidates.candidates(norm, cap, prefilter_k, top_k, ids.select("s1_id")).join(ids.select("s1_id", "shard"), "s1_id")
        self.write(found, f"cand/{split}", partition_by="shard", parts=shards)
        report = candidates.blocking_report(norm, readers.read_shards(self.spark, f"{self.work}/cand/{split}", shards), cap)
        if split == "train":
            report["candidates"] = self.evaluate(shards)
        return self.report(f"blocking_{split}", report)

    def features(self, split: str, shards: list[int] | None = None) -> dict:
        cand = readers.read_shards(self.spark, f"{self.work}/cand/{split}", shards)
        shard_of = cand.select("s1_id", "shard").distinct()
        rows = features.features(cand.drop("shard"), self.read(f"norm/{split}"), self.read("gt_pairs") if split == "train" else None)
        self.write(rows.join(shard_of, "s1_id"), f"feat/{split}", partition_by="shard", parts=shards)
        done = self.read(f"feat/{split}")
        report = {"pairs": done.count()}
        if split == "train":
            report["label_rate"] = done.agg(F.round(F.avg("label"), 6)).first()[0]
            report["features"] = [r.asDict() for r in features.label_comparison(done).collect()]
        return self.report(f"features_{split}", report)

    def universe(self, shards: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
        """Validation ids with their country, and their true pairs."""
        country = self.read("norm/train").where("source = 1").select(F.col("entity_id").alias("s1_id"), "country")
        ids = self.ids("train", shards).where("fold = 'val'").select("s1_id").join(country, "s1_id")
        return ids, self.read("gt_pairs").join(ids.select("s1_id"), "s1_id", "left_semi")

    def evaluate(self, shards: list[int] | None = None) -> dict:
        ids, truth = self.universe(shards)
        cand = readers.read_shards(self.spark, f"{self.work}/cand/train", shards)
        parts = [f(cand, truth, ids) for f in (evaluate.recall, evaluate.oracle_f05)] + [evaluate.pairs_per_s1(cand, ids)]
        out = {k: v for p in parts for k, v in p.first().asDict().items()}
        return out | {"recall_by_country": {r.country: r.recall for r in evaluate.recall_by_country(cand, truth, ids).collect()}}

    def evaluate_predictions(self, pred: DataFrame, threshold: float | None = None, shards: list[int] | None = None) -> dict:
        ids, truth = self.universe(shards)
        threshold = threshold if threshold is not None else evaluate.best_threshold(evaluate.threshold_curve(pred, truth, ids)).first().threshold
        out = evaluate.prediction_report(pred, threshold, truth, ids).first().asDict()
        by = evaluate.f05_by_country(pred.where(F.col("prob") >= threshold), truth, ids)
        return out | {"per_country": {r.country: r.macro_f05 for r in by.collect()}}

    def baseline(self, split: str, shards: list[int] | None = None) -> dict:
        cand = readers.read_shards(self.spark, f"{self.work}/cand/{split}", shards)
        pred = assign.baseline(cand)
        if split == "train":
            best = self.evaluate_predictions(pred, None, shards)
            plain = self.evaluate_predictions(cand.withColumn("prob", F.round("cheap_score", 6)), best["threshold"], shards)
            return self.report("baseline_val", {**best, "pairs_before": cand.count(), "pairs_after": pred.count(), "macro_f05_without_one_to_one": plain["macro_f05"]})
        threshold = readers.read_json(self.spark, f"{self.work}/reports/baseline_val.json")["threshold"]
        self.write(assign.kept(pred, threshold), "pred/test_baseline")
        done = self.read("pred/test_baseline")
        return {"pairs": done.count(), "kept": done.where("kept").count()}

    def train(self, max_rows: int | None = None, **options) -> dict:
        from linkmill.plans import model

        rows = self.read("feat/train")
        fitted = model.train(rows, self.read("splits"), max_rows, **options)
        fitted.write().overwrite().save(f"{self.work}/model")
        ids, truth = self.universe()
        pred = model.predict(fitted, rows)
        threshold = model.tuned(pred, truth, ids)
        return self.report("train", {**self.evaluate_predictions(assign.one_to_one(pred), threshold), "importances": model.importances(fitted)})

    def predict(self) -> dict:
        from pyspark.ml import PipelineModel

        from linkmill.plans import model

        threshold = readers.read_json(self.spark, f"{self.work}/reports/train.json")["threshold"]
        pred = assign.one_to_one(model.predict(PipelineModel.load(f"{self.work}/model"), self.read("feat/test")))
        self.write(assign.kept(pred, threshold), "pred/test_model")
        return {"pairs": self.read("pred/test_model").count()}

    def output(self, source: str = "baseline", check_ids: bool = False) -> tuple[list[str], list[str]]:
        """Both files, in the order of the source; then they are validated. `dry-run` writes empty matches."""
        ids = self.read("raw/test_s1").select(F.col("entity_id").alias("s1_id"), "ord")
        cand = self.read("cand/test") if self.has("cand/test") else None
        empty = self.spark.createDataFrame([], "s1_id string, other_id string, prob double, cheap_score double")
        cand = cand if cand is not None and source != "dry-run" else empty
        match = empty if source == "dry-run" else self.read(f"pred/test_{source}").where("kept")
        for pairs in (cand, match):
            validate.check_known(pairs, ids)
        validate.check_matches_in_candidates(match, cand)
        writers.write_id_lists(ids, cand, f"{self.work}/output/candidate_pairs.tsv", "candidate_entity_ids", [F.desc("cheap_score")])
        writers.write_id_lists(ids, match, f"{self.work}/output/matching_results.tsv", "matched_entity_ids")
        return self.validate(check_ids)

    def validate(self, check_ids: bool = False) -> tuple[list[str], list[str]]:
        test = f"{self.data}/test/test_source"
        return validate.validate(self.spark, f"{self.work}/output/matching_results.tsv", f"{self.work}/output/candidate_pairs.tsv", f"{test}1.tsv", [f"{test}{k}.tsv" for k in (2, 3)] if check_ids else None)

    def all(self, **options) -> dict:
        """Every stage in order, with seconds."""
        took = {}

        def timed(name, f, *args, **kw):
            began = time.time()
            f(*args, **kw)
            took[name] = round(time.time() - began, 1)

        timed("ingest", self.ingest)
        timed("splits", self.splits)
        timed("aliases", self.aliases, **options)
        for split in ("train", "test"):
            timed(f"normalize_{split}", self.normalize, split)
            timed(f"blocking_{split}", self.blocking, split)
            timed(f"features_{split}", self.features, split)
            timed(f"baseline_{split}", self.baseline, split)
        timed("output", self.output)
        return self.report("pipeline", took)


def main(args: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="linkmill", description=__doc__)
    ap.add_argument("stage", choices=(*STAGES, "all"))
    ap.add_argument("--data", required=True, help="folder of train/ and test/ files")
    ap.add_argument("--work", required=True, help="folder of results")
    ap.add_argument("--split", choices=("train", "test"), default="train")
    ap.add_argument("--shards", help="numbers, joined by commas")
    ap.add_argument("--limit", type=int)
    ap.add_argument("--force", action="store_true")
    ap.add_argument("--threshold", type=float)
    ap.add_argument("--source", choices=("baseline", "model", "dry-run"), default="baseline")
    ap.add_argument("--check-ids", action="store_true")
    ap.add_argument("--show-misses", type=int, default=0)
    o = ap.parse_args(args)
    spark = SparkSession.builder.appName("linkmill").getOrCreate()
    run = Run(spark, o.data, o.work, o.force)
    shards = [int(x) for x in o.shards.split(",")] if o.shards else None
    if o.stage in ("write", "validate"):
        errors, warnings = run.output(o.source, o.check_ids) if o.stage == "write" else run.validate(o.check_ids)
        print("\n".join([*(f"WARNING {x}" for x in warnings), *(f"ERROR {x}" for x in errors)]) or "OK")
        return 1 if errors else 0
    by_split = {"normalize": lambda: run.normalize(o.split, o.limit), "blocking": lambda: run.blocking(o.split, shards), "features": lambda: run.features(o.split, shards), "baseline": lambda: run.baseline(o.split, shards)}
    if o.stage == "evaluate":
        result = run.evaluate(shards) if o.source == "dry-run" else run.evaluate_predictions(assign.baseline(readers.read_shards(spark, f"{run.work}/cand/train", shards)), o.threshold, shards)
    else:
        result = by_split[o.stage]() if o.stage in by_split else getattr(run, o.stage)()
    print(json.dumps(result, indent=2, default=str))
    if o.stage == "blocking" and o.split == "train" and o.show_misses:
        candidates.show_misses(run.universe(shards)[1], run.read("cand/train"), run.raw("train"), o.show_misses).show(truncate=False)
    return 0
