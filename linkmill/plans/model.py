"""Gradient-boosted trees over the pair features: training on one fold, early stopping on the other, prediction.

An equivalent of the planned learner with Spark's own trees, not a reproduction of another library's results."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.functions import vocab
from linkmill.operators.assign import one_to_one
from linkmill.operators.evaluate import best_threshold, threshold_curve
from linkmill.operators.features import FEATURES
from linkmill.operators.splits import sample_groups


def train(rows: DataFrame, folds: DataFrame, max_rows: int | None = None, rounds: int = 100, depth: int = 5, rate: float = 0.1, seed: int = vocab.SEED) -> PipelineModel:
    """rows: s1_id, other_id, FEATURES, label; folds: s1_id, fold. Above max_rows, a seeded part of the s1 groups is used."""
    if max_rows is not None and (n := rows.count()) > max_rows:
        rows = sample_groups(rows, "s1_id", max_rows / n, seed)
    data = rows.join(folds.select("s1_id", (F.col("fold") == "val").alias("validation")), "s1_id").withColumn("label", F.col("label").cast("double"))
    trees = GBTClassifier(featuresCol="vector", labelCol="label", validationIndicatorCol="validation", maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="vector"), trees]).fit(data)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """s1_id, other_id, prob. The order of columns must be the one of training."""
    if list(model.stages[0].getInputCols()) != list(FEATURES):
        raise ValueError("the model was trained on other columns")
    return model.transform(rows).select("s1_id", "other_id", F.round(vector_to_array("probability")[1], 6).alias("prob"))


def tuned(pred: DataFrame, truth: DataFrame, val_ids: DataFrame) -> float:
    """Assigned one to one over all folds, the threshold is chosen on the validation ids."""
    return best_threshold(threshold_curve(one_to_one(pred), truth, val_ids)).first().threshold


def importances(model: PipelineModel, top: int = 20) -> list[tuple[str, float]]:
    return sorted(zip(FEATURES, map(float, model.stages[-1].featureImportances.toArray()), strict=True), key=lambda x: -x[1])[:top]


def errors(pred: DataFrame, truth: DataFrame, threshold: float, n: int = 30) -> DataFrame:
    """kind, s1_id, other_id, prob: the n most certain false positives and n missed pairs with the highest prob."""
    wrong = pred.where(F.col("prob") >= threshold).join(truth, ["s1_id", "other_id"], "left_anti").orderBy(F.desc("prob"), "s1_id", "other_id").limit(n)
    kept = pred.where(F.col("prob") >= threshold).select("s1_id", "other_id")
    missed = truth.join(kept, ["s1_id", "other_id"], "left_anti").join(pred, ["s1_id", "other_id"], "left").orderBy(F.desc_nulls_last("prob"), "s1_id", "other_id").limit(n)
    return wrong.select(F.lit("false positive").alias("kind"), "s1_id", "other_id", "prob").unionByName(missed.select(F.lit("false negative").alias("kind"), "s1_id", "other_id", "prob"))
