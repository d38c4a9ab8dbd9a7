"""Trees walked in an expression against the models' own transform, and the fold against the loop."""

import pytest
from pyspark.sql import functions as F

from tests.fixtures import rows
from trendcast.operators import models, recursive, walk

NAMES = ["trend", "lag_1", "lag_2", "growth_rate_lag_1"]
SIZES = {models.FOREST: {"n_estimators": 40, "max_depth": 5}, models.BOOSTING: {"n_estimators": 30, "max_depth": 3}}


@pytest.fixture(scope="module")
def training(spark):
    n = [100 + 7 * t + (t * t * 37) % 61 for t in range(60)]
    data = [(t, float(n[t]), float(n[t - 1]), float(n[t - 2]), (n[t - 1] - n[t - 2]) / n[t - 2]) for t in range(2, 60)]
    return spark.createDataFrame(data, "trend int, n double, lag_1 double, lag_2 double, growth_rate_lag_1 double")


@pytest.mark.parametrize("name", models.TREE_MODELS)
def test_walk_equals_transform(spark, training, name):
    fitted = models.fit_model(name, training, NAMES, params=SIZES[name])
    compiled = walk.compile_trees(fitted)
    assert len(compiled.trees) == fitted.model.getNumTrees and compiled.depth <= SIZES[name]["max_depth"]
    assert sum(len(nodes) for _, nodes in compiled.trees) == fitted.model.totalNumNodes
    # Rows of training, and rows that lie on thresholds.
    edges = [(int(t) if f == 0 else 5, t if f == 1 else 150.0, t if f == 2 else 150.0, t if f == 3 else 0.0)
             for _, nodes in compiled.trees for f, t, _, _ in nodes if f is not None]
    asked = training.select(*NAMES).unionByName(
        spark.createDataFrame(edges, "trend int, lag_1 double, lag_2 double, growth_rate_lag_1 double"))
    both = walk.with_trees(fitted.transform(asked), compiled).select(
        "predicted", walk.tree_predictor(compiled, NAMES)({}).alias("walked")).collect()
    want = [r["predicted"] for r in both]
    assert [r["walked"] for r in both] == (want if name == models.FOREST else pytest.approx(want, rel=1e-14))


def test_a_stump_without_splits_and_null_features(spark, training):
    flat = training.withColumn("n", F.lit(4.5))
    compiled = walk.compile_trees(models.fit_model(models.FOREST, flat, NAMES, params={"n_estimators": 3}))
    assert compiled.depth == 0
    asked = spark.createDataFrame([(1, 2.0, 3.0, None), (1, 2.0, 3.0, 0.0)],
                                  "trend int, lag_1 double, lag_2 double, growth_rate_lag_1 double")
    out = walk.with_trees(asked, compiled).select(walk.tree_predictor(compiled, NAMES)({}).alias("y"))
    assert rows(out, "y") == [(None,), (4.5,)]


@pytest.mark.parametrize("mode", recursive.MODES)
@pytest.mark.parametrize("zero_growth, clip", [(False, True), (True, False)])
def test_fold_equals_loop_to_the_last_bit(spark, training, mode, zero_growth, clip):
    start = spark.createDataFrame(
        [("a", 59, 57, 400.0, 390.0, 0.02), ("b", 30, 29, 210.0, 260.0, -0.1)],
        "k string, last_period int, last_trend int, last_value double, previous_value double, last_growth double")
    fitted = models.fit_model(models.FOREST, training, NAMES, params=SIZES[models.FOREST])
    options = dict(keys=["k"], features=NAMES, mode=mode, zero_growth=zero_growth, clip=clip)
    fold = recursive.forecast(start, fitted, 6, **options)
    loop = recursive.loop_forecast(start, fitted, 6, **options)
    assert fold.columns == loop.columns
    assert sorted(map(tuple, fold.collect())) == sorted(map(tuple, loop.collect()))
    plan = fold._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
