import random

import numpy as np
import pytest

from trendcast.operators import backtest, models, splits, trees

FEATURES = ["a", "b", "c"]
WINDOWS = [splits.Window(30, 31, 33), splits.Window(34, 35, 38)]


def best_split(rows, l2=0.0, least=1):
    """Plain search over all features and values: (gain, feature, value), or None."""
    def score(part):
        return sum(y for *_, y in part) ** 2 / (len(part) + l2)

    found = None
    for f in range(3):
        for v in sorted({r[f] for r in rows}):
            left, right = [r for r in rows if r[f] <= v], [r for r in rows if r[f] > v]
            if min(len(left), len(right)) >= least:
                gain = score(left) + score(right) - score(rows)
                if gain > 1e-9 * max(1.0, score(rows)) and (found is None or gain > found[0] + 1e-12):
                    found = gain, f, v
    return found


def plain_tree(rows, depth, node=1, l2=0.0, least=1):
    split = best_split(rows, l2, least) if depth else None
    value = sum(y for *_, y in rows) / (len(rows) + l2)
    if not split:
        return {node: (None, None, len(rows), value)}
    _, f, v = split
    out = {node: (FEATURES[f], v, len(rows), value)}
    out |= plain_tree([r for r in rows if r[f] <= v], depth - 1, 2 * node, l2, least)
    return out | plain_tree([r for r in rows if r[f] > v], depth - 1, 2 * node + 1, l2, least)


@pytest.fixture(scope="module")
def plain():
    rng = random.Random(1)
    return [(rng.randrange(9), rng.choice([0.5, 1.5, 2.5]), float(i), float(rng.randrange(50) + 3 * i)) for i in range(40)]


@pytest.fixture(scope="module")
def rows(spark, plain):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(plain, 1)], "period int, a int, b double, c double, n double").cache()


@pytest.mark.parametrize("depth, least", [(1, 1), (4, 1), (3, 5)])
def test_a_single_tree_equals_a_plain_search(rows, plain, depth, least):
    got = {r.node: (r.feature, r.threshold, r.rows, round(r.value, 9))
           for r in trees.single_tree(rows, FEATURES, depth, min_leaf=least).collect()}
    want = {k: (f, v, n, round(x, 9)) for k, (f, v, n, x) in plain_tree(plain, depth, least=least).items()}
    assert got == want


def test_a_forest_of_whole_samples_is_a_tree(rows, plain, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(trees, "poisson_one", lambda u: F.lit(1))
    grid = splits.parameter_grid({"n_estimators": [1, 3], "max_depth": [1, 3], "min_samples_leaf": [1, 4]})
    out = trees.forest_predictions(rows, FEATURES, WINDOWS, grid).collect()
    assert len(out) == 8 * 7
    for r in out:
        p = [q for q in grid if backtest.params_json(q) == r.hyperparameters][0]
        tree, node = plain_tree(plain[:WINDOWS[r.window_id - 1].train_end], p["max_depth"], least=p["min_samples_leaf"]), 1
        while tree[node][0]:
            node = 2 * node + (plain[r.period - 1][FEATURES.index(tree[node][0])] > tree[node][1])
        assert r.predicted == pytest.approx(tree[node][3])


def test_boosting_in_a_task_equals_plain_rounds(rows, plain):
    grid = [{"n_estimators": n, "max_depth": 2, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0} for n in (1, 4)]
    out = {(r.hyperparameters, r.period): r.predicted for r in trees.boosted_predictions(rows, FEATURES, WINDOWS[:1], grid).collect()}
    train = plain[:30]
    mean = sum(r[3] for r in train) / 30
    predicted = [mean] * len(plain)
    for n in range(1, 5):
        tree = plain_tree([(*r[:3], r[3] - p) for r, p in zip(train, predicted)], 2, l2=1.0)
        for i, r in enumerate(plain):
            node = 1
            while tree[node][0]:
                node = 2 * node + (r[FEATURES.index(tree[node][0])] > tree[node][1])
            predicted[i] += 0.3 * tree[node][3]
        if n in (1, 4):
            name = backtest.params_json(grid[0] if n == 1 else grid[1])
            for period in (31, 32, 33):
                assert out[name, period] == pytest.approx(predicted[period - 1])


def test_boosting_by_level_equals_boosting_in_tasks(rows):
    grid = splits.parameter_grid({"n_estimators": [1, 2], "max_depth": [1, 2], "learning_rate": [0.1]})
    near, far = ({(r.hyperparameters, r.window_id, r.period): r.predicted for r in trees.boosted_predictions(
        rows, FEATURES, WINDOWS, grid, rows_in_task=n).collect()} for n in (100, 0))
    assert near.keys() == far.keys() and len(near) == 4 * 7
    assert all(near[k] == pytest.approx(far[k]) for k in near)


def test_draws(spark):
    from pyspark.sql import functions as F

    df = spark.range(20_000).select(trees.uniform("7", F.col("id")).alias("u"), "id")
    got = df.select("u", trees.poisson_one(F.col("u")).alias("w"), "id").collect()
    assert all(r.u == trees.uniform_of(7, r.id) for r in got[:50])
    assert np.mean([r.w for r in got]) == pytest.approx(1, abs=0.03) and np.var([r.w for r in got]) == pytest.approx(1, abs=0.05)
    assert trees._features_drawn(1, 1, 10, 0.9) == trees._features_drawn(1, 1, 10, 0.9)
    assert len(trees._features_drawn(1, 2, 10, 0.9)) == 9


def test_tuning_ranks_both_models_and_a_bad_name_is_refused(rows):
    grids = {models.FOREST: splits.parameter_grid({"n_estimators": [2, 4], "max_depth": [2], "min_samples_leaf": [1, 2]}),
             models.BOOSTING: splits.parameter_grid({"n_estimators": [5, 50], "max_depth": [2], "learning_rate": [0.1]})}
    tables, best = trees.tune_jointly(rows, FEATURES, WINDOWS, grids, clip=True)
    for name, grid in grids.items():
        found = tables[name].collect()
        assert len(found) == len(grid) and best[name] in grid
        assert min(found, key=lambda r: (r.average_RMSE, r.average_MAE)).hyperparameters == backtest.params_json(best[name])
    assert best[models.BOOSTING]["n_estimators"] == 50
    with pytest.raises(ValueError):
        trees.backtest_grid(models.LINEAR, rows, FEATURES, WINDOWS, [{}])
