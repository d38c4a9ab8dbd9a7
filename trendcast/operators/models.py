"""Forecasters behind one ``fit``: naive, least squares, forest, boosting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import SparkContext
from pyspark.ml.base import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trendcast.operators.ols import fit_ols

# Display names.
NAIVE = "Naive Last Value"
LINEAR = "Linear Regression"
FOREST = "Random Forest"
BOOSTING = "Gradient Boosting"
MODEL_NAMES = (NAIVE, LINEAR, FOREST, BOOSTING)
TREE_MODELS = (FOREST, BOOSTING)

# Default parameters of the two tree models.
FOREST_DEFAULTS = {"n_estimators": 300, "max_depth": 5, "min_samples_leaf": 1}
BOOSTING_DEFAULTS = {
    "n_estimators": 200, "learning_rate": 0.05, "max_depth": 4, "subsample": 0.9, "colsample_bytree": 0.9,
}
MAX_BINS = 256
# The tuning grids.
FOREST_GRID = {"n_estimators": [100, 300, 500], "max_depth": [3, 5, 8], "min_samples_leaf": [1, 2, 4]}
BOOSTING_GRID = {"learning_rate": [0.01, 0.05, 0.1], "max_depth": [2, 3, 4], "n_estimators": [100, 300, 500]}


def check_model_name(name: str) -> None:
    if name not in MODEL_NAMES:
        raise ValueError(f"unknown model {name!r}; use one of {', '.join(MODEL_NAMES)}")


def tree_estimator(name: str, params: Mapping[str, float] | None = None, seed: int = 42):
    """The ``pyspark.ml`` estimator for a tree model.

    The parameter ``max_bins`` (256), above the number of distinct values of a
    feature, makes every value a possible split; below it Spark splits on quantiles.
    """
    params = dict(params or {})
    max_bins = int(params.get("max_bins", MAX_BINS))
    if name == FOREST:
        p = FOREST_DEFAULTS | params
        return RandomForestRegressor(
            featuresCol="features", labelCol="__label", predictionCol="predicted",
            numTrees=int(p["n_estimators"]), maxDepth=int(p["max_depth"]),
            minInstancesPerNode=int(p["min_samples_leaf"]), featureSubsetStrategy="all",
            maxBins=max_bins, seed=seed,
        )
    if name == BOOSTING:
        p = BOOSTING_DEFAULTS | params
        return GBTRegressor(
            featuresCol="features", labelCol="__label", predictionCol="predicted", lossType="squared",
            maxIter=int(p["n_estimators"]), stepSize=float(p["learning_rate"]), maxDepth=int(p["max_depth"]),
            subsamplingRate=float(p["subsample"]), featureSubsetStrategy=str(p["colsample_bytree"]),
            maxBins=max_bins, seed=seed,
        )
    raise ValueError(f"{name!r} is not a tree model")


@dataclass(frozen=True)
class NaiveModel:
    """Repeats the previous period."""

    features: tuple[str, ...] = ("lag_1",)

    def predict(self, values: Mapping[str, Column]) -> Column:
        return values["lag_1"].cast("double")

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("predicted", self.predict({"lag_1": F.col("lag_1")}))


@dataclass(frozen=True)
class LinearModel:
    """Least-squares coefficients of one series."""

    features: tuple[str, ...]
    intercept: float
    coef: tuple[float, ...]

    def predict(self, values: Mapping[str, Column]) -> Column:
        total = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coef):
            total = total + F.lit(weight) * values[name].cast("double")
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("predicted", self.predict({f: F.col(f) for f in self.features}))


@dataclass(frozen=True)
class TreeModel:
    """A fitted ``pyspark.ml`` tree ensemble and the order of its features."""

    features: tuple[str, ...]
    model: Model

    def transform(self, df: DataFrame) -> DataFrame:
        assembled = assemble(df, self.features)
        return self.model.transform(assembled).drop("features")


def first_rounds(fitted: TreeModel, rounds: int) -> TreeModel:
    """The boosted model after its first ``rounds`` trees: what a fit of so many rounds gives, as each round builds on
    those before it and has a seed of its own."""
    model = fitted.model
    if rounds >= model.getNumTrees:
        return fitted
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(java.trees()[:rounds], java.treeWeights()[:rounds])):
        trees[i], weights[i] = tree, weight
    shorter = gateway.jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"{java.uid()}_{rounds}", trees, weights)
    shorter.setFeaturesCol(model.getFeaturesCol())
    shorter.setPredictionCol(model.getPredictionCol())
    return TreeModel(fitted.features, GBTRegressionModel(shorter))


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    doubles = {f"__x{i}": F.col(f).cast("double") for i, f in enumerate(features)}
    out = VectorAssembler(inputCols=list(doubles), outputCol="features").transform(df.withColumns(doubles))
    return out.drop(*doubles)


def fit_model(
    name: str,
    df: DataFrame,
    features: Sequence[str],
    target: str = "n",
    params: Mapping[str, float] | None = None,
    seed: int = 42,
) -> Any:
    """Fit one model on all rows of ``df``; the result's ``transform`` adds ``predicted``."""
    check_model_name(name)
    features = tuple(features)
    if name == NAIVE:
        return NaiveModel()
    if name == LINEAR:
        row = fit_ols(df, features, target).select("intercept", "coef").first()
        if row is None:
            raise ValueError("no rows to fit on")
        return LinearModel(features, row["intercept"], tuple(row["coef"]))
    rows = assemble(df.withColumn("__label", F.col(target).cast("double")), features)
    return TreeModel(features, tree_estimator(name, params, seed).fit(rows.select("__label", "features")))


def coefficient_table(coefs: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``fit_ols`` output as rows: the intercept first, then coefficients from high to low."""
    names = F.array(*[F.lit(f) for f in features])
    pairs = F.arrays_zip(names.alias("feature"), F.col("coef").alias("coefficient"))
    slopes = coefs.select(*by, F.inline(pairs)).toDF(*by, "feature", "coefficient")
    intercepts = coefs.select(*by, F.lit("intercept").alias("feature"), F.col("intercept").alias("coefficient"))
    order = F.when(F.col("feature") == "intercept", 0).otherwise(1)
    return intercepts.unionByName(slopes).orderBy(*by, order, F.desc("coefficient"))


def importance_table(spark: SparkSession, fitted: TreeModel) -> DataFrame:
    """Feature importances of a tree model, high to low."""
    rows = list(zip(fitted.features, fitted.model.featureImportances.toArray().tolist()))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
