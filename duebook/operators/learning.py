"""Fitted models on Spark ML: boosted trees for default and for value at risk, tuning and importances.

Trees are built from histograms over the distributed training rows; rows keep their key from input to score.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.keys import hash_bucket
from duebook.operators.scorecard import assert_no_leakage

SEED = 42
CATEGORIES = ("sector", "size_band")
# The tuning space.
DEPTHS, ROUNDS, STEPS, SAMPLING = (2, 3, 4), (10, 15, 20), (0.05, 0.1, 0.2), (0.7, 0.85, 1.0)


def encoded(numeric: Sequence[str], categories: Sequence[str] = CATEGORIES) -> list:
    """Stages that index and one-hot the categories (unseen ones kept) and assemble ``features``."""
    assert_no_leakage([*numeric, *categories])
    indexed = [f"{c}_index" for c in categories]
    hot = [f"{c}_hot" for c in categories]
    return [
        StringIndexer(inputCols=list(categories), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=hot, handleInvalid="keep"),
        VectorAssembler(inputCols=[*numeric, *hot], outputCol="features"),
    ]


def add_class_weight(train: DataFrame) -> DataFrame:
    """Positives weigh negatives / positives."""
    balance = train.agg(
        F.try_divide(F.sum(1 - F.col("label")).cast("double"), F.sum("label").cast("double"))
    ).scalar()
    return train.withColumn("weight", F.when(F.col("label") == 1, F.coalesce(balance, F.lit(1.0))).otherwise(1.0))


def default_classifier() -> GBTClassifier:
    return GBTClassifier(labelCol="label", weightCol="weight", maxDepth=3, maxIter=20, stepSize=0.1, seed=SEED)


def fit_default_model(train: DataFrame, numeric: Sequence[str]) -> PipelineModel:
    return Pipeline(stages=[*encoded(numeric), default_classifier()]).fit(add_class_weight(train))


def score_default(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Keyed scores; nothing depends on row order."""
    scored = model.transform(rows)
    return scored.withColumn("score", F.round(vector_to_array("probability")[1], 6)).withColumn(
        "predicted", F.col("prediction").cast("int")
    )


def fit_value_model(train: DataFrame, numeric: Sequence[str], target: str) -> PipelineModel:
    parents = {"billed_90d", "overdue_rate", target}
    if parents.intersection(numeric):
        raise ValueError(f"the target is computed from {sorted(parents.intersection(numeric))}")
    regressor = GBTRegressor(labelCol=target, maxDepth=3, maxIter=20, stepSize=0.1, seed=SEED)
    return Pipeline(stages=[*encoded(numeric), regressor]).fit(train)


def importances(model: PipelineModel, rows: DataFrame, top: int = 15) -> DataFrame:
    """The ``top`` gain importances with the names of the assembled columns."""
    meta = model.transform(rows.limit(1)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in meta.values() for a in group}
    weights = model.stages[-1].featureImportances.toArray()
    listed = [(names.get(i, f"feature_{i}"), float(w)) for i, w in enumerate(weights)]
    table = rows.sparkSession.createDataFrame(listed, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def add_folds(df: DataFrame, key: str, folds: int) -> DataFrame:
    return df.withColumn("fold", hash_bucket(F.col(key), folds, "fold").cast("int"))


def random_grid(model, trials: int, seed: int = SEED) -> list[dict]:
    """``trials`` random settings from the tuning space, the same ones for the same seed."""
    pick = random.Random(seed)
    return [
        {
            model.maxDepth: pick.choice(DEPTHS),
            model.maxIter: pick.choice(ROUNDS),
            model.stepSize: pick.choice(STEPS),
            model.subsamplingRate: pick.choice(SAMPLING),
        }
        for _ in range(trials)
    ]


def tune(train: DataFrame, numeric: Sequence[str], key: str, trials: int = 30, folds: int = 5, target: str = "label"):
    """Mean fold metric per setting (AUC for the classifier, MAE for a regression target), as a table.

    Features are encoded once; settings and folds are fitted side by side.
    """
    if target == "label":
        model = default_classifier()
        judge = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
        weighted = add_class_weight(train)
    else:
        model = GBTRegressor(labelCol=target, seed=SEED)
        judge = RegressionEvaluator(labelCol=target, metricName="mae")
        weighted = train
    ready = Pipeline(stages=encoded(numeric)).fit(weighted).transform(weighted)
    grid = random_grid(model, trials)
    search = CrossValidator(
        estimator=model, estimatorParamMaps=grid, evaluator=judge, foldCol="fold", numFolds=folds, parallelism=4
    )
    keep = [key, "features", target, "fold"] + (["weight"] if target == "label" else [])
    metrics = search.fit(add_folds(ready, key, folds).select(*keep)).avgMetrics
    rows = [
        (i, g[model.maxDepth], g[model.maxIter], g[model.stepSize], g[model.subsamplingRate], float(m))
        for i, (g, m) in enumerate(zip(grid, metrics), 1)
    ]
    schema = "trial int, depth int, rounds int, step double, sampling double, mean_metric double"
    table = train.sparkSession.createDataFrame(rows, schema)
    return table.orderBy(F.desc("mean_metric") if judge.isLargerBetter() else F.asc("mean_metric"), "trial")
