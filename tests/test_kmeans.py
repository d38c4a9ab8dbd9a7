import random

import numpy as np
import pytest

from trendcast.operators import kmeans, segment


@pytest.fixture(scope="module")
def points():
    rng = random.Random(4)
    return [[rng.gauss(c[0], 1), rng.gauss(c[1], 1)] for c in ((0, 0), (9, 0), (0, 9)) for _ in range(200)]


@pytest.fixture(scope="module")
def df(spark, points):
    return spark.createDataFrame([(i, p) for i, p in enumerate(points)] + [(-1, None)], "id long, v array<double>").repartition(5).cache()


def lloyd(rows, centres):
    for _ in range(300):
        label = ((rows[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        after = np.array([rows[label == i].mean(0) if (label == i).any() else c for i, c in enumerate(centres)])
        settled = ((after - centres) ** 2).sum(1).max() <= kmeans.TOLERANCE ** 2
        centres = after
        if settled:
            break
    return centres, ((rows[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


def test_joint_fits_equal_the_best_of_single_fits(df, points):
    rows = np.array(points)
    fits = kmeans.fit_many(df, "v", (2, 3, 5), range(4))
    starts = np.array([r.v for r in df.where("v is not null").selectExpr("v", "xxhash64(v) as h").orderBy("h", "v").collect()])
    for k, fit in fits.items():
        single = [lloyd(rows, kmeans.starting_centres(starts, k, seed))[1] for seed in range(4)]
        assert fit.cost == pytest.approx(min(single)) and len(fit.centres) == k
    from pyspark.ml.functions import array_to_vector

    features = df.where("v is not null").select(array_to_vector("v").alias("features"))
    assert fits[3].cost <= segment.fit_kmeans(features, 3, range(4)).summary.trainingCost * (1 + 1e-6)


def test_euclidean_silhouettes_of_the_fits(df, points):
    scores, fits = segment.best_fits(df, "v", (2, 3), restarts=3)
    got = {r.k: r.silhouette_score for r in scores.collect()}
    rows = np.array(points)
    dist = np.sqrt(((rows[:, None] - rows[None]) ** 2).sum(2))
    for k, fit in fits.items():
        label = ((rows[:, None] - fit.centres[None]) ** 2).sum(2).argmin(1)
        s = []
        for i, own in enumerate(label):
            a = dist[i, label == own].sum() / ((label == own).sum() - 1)
            b = min(dist[i, label == c].mean() for c in range(k) if c != own)
            s.append((b - a) / max(a, b))
        assert got[k] == pytest.approx(np.mean(s), abs=5e-5)
    assert scores.first().k == 3
    assert segment.choose_k(df, "v", (2, 3), restarts=3, measure="squared").first().k == 3
    with pytest.raises(ValueError):
        segment.choose_k(df, "v", measure="cosine")


def test_equal_rows_and_an_empty_table(spark):
    same = spark.createDataFrame([([1.0, 2.0],)] * 5, "v array<double>")
    assert [tuple(r) for r in segment.choose_k(same, "v", (2, 3), restarts=2).orderBy("k").collect()] == [(2, None), (3, None)]
    assert segment.choose_k(same.limit(0), "v", (2, 3)).count() == 0


def test_weights_stand_for_copies_and_one_sum_a_fit_reaches_the_driver(spark, df, points, monkeypatch):
    copies = spark.createDataFrame([(p, 1 + i % 3) for i, p in enumerate(points)], "v array<double>, w int")
    written_out = spark.createDataFrame([(p,) for i, p in enumerate(points) for _ in range(1 + i % 3)], "v array<double>")
    joint, single = kmeans.fit_many(copies, "v", (2, 3), range(2), weight="w"), kmeans.fit_many(written_out, "v", (2, 3), range(2))
    for k in joint:
        assert joint[k].cost == pytest.approx(single[k].cost) and joint[k].centres == pytest.approx(single[k].centres)
    sent = []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: sent.append(collect(self)) or sent[-1])
    monkeypatch.setattr(type(df), "toLocalIterator", lambda self, **k: iter(self.collect()))
    kmeans._pass(kmeans.packed(df.repartition(5), "v"), [np.zeros((2, 2)), np.ones((3, 2))])
    assert sum(map(len, sent)) == 2


def test_blocks_are_stored_before_the_first_pass(spark, monkeypatch):
    spark.catalog.clearCache()
    whole, stored = kmeans._pass, []

    def look(blocks, fits):
        stored.append([(i.numCachedPartitions(), i.numPartitions()) for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()])
        return whole(blocks, fits)

    monkeypatch.setattr(kmeans, "_pass", look)
    df = spark.createDataFrame([([float(i % 3), float(i % 5)],) for i in range(60)], "v array<double>").repartition(3)
    assert set(kmeans.fit_many(df, "v", (2,), (1,))) == {2}
    assert any(n == m > 0 for n, m in stored[0])
