"""Probability classifiers by kind, scoring with the rule blend, feature importance."""

from __future__ import annotations

import math
import warnings

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from sievepoint.constants import FILL_NUMBER, SCORE_THRESHOLD
from sievepoint.models.boosting import PenalisedTrees
from sievepoint.operators.rules import blend, decide
from sievepoint.operators.trim import feature_matrix

KINDS = {
    "boosted_trees": GBTClassifier, "gradient_boosting": GBTClassifier,
    "random_forest": RandomForestClassifier, "logistic": LogisticRegression,
    "decision_tree": DecisionTreeClassifier, "gaussian_nb": NaiveBayes, "penalised_trees": PenalisedTrees,
}
# Parameters of the trees with leaf penalties, which have names of their own.
PENALISED = {"reg_lambda": "regLambda", "reg_alpha": "regAlpha", "colsample_bytree": "colsampleByTree",
             "colsample_bylevel": "colsampleByLevel", "min_child_weight": "minChildWeight"}

# Rows that one task of a fit keeps and reads at most.
ROWS_A_PART = 250_000

# Production and search settings of the boosted trees.
PRODUCTION_PARAMS = {"max_depth": 5, "n_estimators": 600, "colsample_bytree": 0.5, "colsample_bylevel": 0.7}
SEARCH_GRID = {
    "n_estimators": [100, 300, 500], "max_depth": [5, 10, 15], "subsample": [0.3, 0.5, 0.7],
    "colsample_bytree": [0.3, 0.5, 0.7], "colsample_bylevel": [0.5, 0.7, 1.0],
    "reg_lambda": [1, 3, 5], "reg_alpha": [1, 3, 5], "learning_rate": [0.01, 0.1, 0.2],
}


def effective(kind: str, params: dict) -> dict:
    """The parameters that have an effect on ``kind``; a search over others would fit the same model again."""
    ignored = () if kind in ("logistic", "penalised_trees") else ("reg_lambda", "reg_alpha")
    return {name: value for name, value in params.items() if name not in ignored}


def spark_params(kind: str, params: dict) -> dict:
    """Common parameter names to those of the Spark estimator; Spark names pass through."""
    rounds = "numTrees" if kind == "random_forest" else "maxIter"
    names = {"n_estimators": rounds, "max_depth": "maxDepth", "subsample": "subsamplingRate",
             "learning_rate": "stepSize", "max_features": "featureSubsetStrategy",
             "min_samples_leaf": "minInstancesPerNode", "random_state": "seed"}
    out, share = {}, 1.0
    for name, value in params.items():
        if kind == "penalised_trees" and name in PENALISED:
            out[PENALISED[name]] = float(value)
        elif name in ("reg_lambda", "reg_alpha") and kind != "logistic":
            warnings.warn(f"{KINDS[kind].__name__} has no leaf-weight penalty: {name} is ignored")
        elif name.startswith("colsample_"):
            share *= value
        elif name == "C":
            out["regParam"] = 1.0 / value
        else:
            out[names.get(name, name)] = value
    if share < 1.0:
        out["featureSubsetStrategy"] = str(round(share, 4))
    return out


def make_classifier(kind: str, params: dict | None = None):
    fixed = {"featuresCol": "features", "labelCol": "label"}
    if kind == "gaussian_nb":
        fixed["modelType"] = "gaussian"
    if kind not in ("logistic", "gaussian_nb"):
        fixed["seed"] = 42
    return KINDS[kind](**{**fixed, **spark_params(kind, params or {})})


def in_parts(rows: DataFrame, most: int = ROWS_A_PART) -> DataFrame:
    """``rows``, dealt evenly to more partitions where one has more than ``most``.

    A fit keeps its rows, binned, in the partitions they come in, and a task reads one whole; a scan of a short file has as
    many partitions as there are cores, however many rows.
    """
    sizes = rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    size = sizes.agg(F.sum("n").alias("n"), F.max("n").alias("largest")).first()
    if (size.largest or 0) <= most:
        return rows
    return rows.repartition(max(math.ceil(size.n / most), rows.sparkSession.sparkContext.defaultParallelism))


def fit(rows: DataFrame, kind: str, params: dict | None = None):
    """A classifier fitted on ``rows``. Naive Bayes sums its rows as they are read and needs no parts."""
    return make_classifier(kind, params).fit(rows if kind == "gaussian_nb" else in_parts(rows))


def assemble(df: DataFrame, features: list[str], keep: tuple[str, ...], label: str | None = None,
             fill: float = FILL_NUMBER) -> DataFrame:
    """(keep..., features vector, label) in fixed feature order."""
    if label:
        df = df.withColumn("label", F.col(label).cast("double"))
        keep = (*keep, "label")
    matrix = feature_matrix(df, features, keep, fill)
    return (VectorAssembler(inputCols=features, outputCol="features").transform(matrix)
            .select(*keep, "features"))


def with_probability(scored: DataFrame, name: str = "prob") -> DataFrame:
    return scored.withColumn(name, vector_to_array("probability")[1]).drop(
        "rawPrediction", "probability", "prediction", "margin")


def blended(df: DataFrame, model, threshold: float = SCORE_THRESHOLD, rule: str | None = "y_rule") -> DataFrame:
    """Assembled rows with ``pred_fraud_prob``, the rule blended in where the column is there."""
    scored = with_probability(model.transform(df))
    prob = blend(F.col("prob"), F.col(rule), threshold) if rule and rule in df.columns else F.col("prob")
    return scored.withColumn("pred_fraud_prob", prob)


def predict(df: DataFrame, model, id_column: str = "app_id", threshold: float = SCORE_THRESHOLD,
            rule: str | None = "y_rule") -> DataFrame:
    """Assembled rows to (id, pred_fraud_prob, pred_fraud), the rule blended in."""
    return blended(df, model, threshold, rule).select(
        id_column, "pred_fraud_prob", decide(F.col("pred_fraud_prob"), threshold).alias("pred_fraud"))


def bypass(df: DataFrame, id_column: str = "app_id") -> DataFrame:
    """Switched-off scoring: probability 0 and class 0 for every row."""
    return df.select(id_column, F.lit(0.0).alias("pred_fraud_prob"), F.lit(0).alias("pred_fraud"))


def importance(spark, model, features: list[str], k: int = 20) -> DataFrame:
    """(rank, feature, score), strongest first; absolute coefficients for a logistic model."""
    weights = model.coefficients if hasattr(model, "coefficients") else model.featureImportances
    scores = sorted(((n, abs(float(w))) for n, w in zip(features, weights.toArray())), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(scores[:k])],
                                 "rank int, feature string, score double")
