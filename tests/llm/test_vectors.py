import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendcast.llm import nearest, neardup
from trendcast.llm.queries import QUERIES

ODD = [(9001, None, 0), (9002, [0.0] * 8, 0), (9003, [1.0, None] + [0.0] * 6, 0), (9004, [float("nan")] + [1.0] * 7, 0),
       (9005, [float("inf")] + [1.0] * 7, 0), (9006, [1.0] * 7, 0), (9007, [1.0] * 8, None)]


def table(spark, n=260, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, 8))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + 0.15 * rng.standard_normal(8)
        rows.append((i, v.astype(np.float32).tolist(), int(rng.integers(3))))
    rows += [(n + k, rows[7][1], rows[7][2]) for k in range(30)] + [(n + 40, [2 * x for x in rows[7][1]], rows[7][2])]
    return rows, spark.createDataFrame(rows + ODD, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "1 as id", "2 as rep", "3 as tile")


@pytest.mark.parametrize("tile_rows", [16, 4096])
def test_near_duplicates_equal_brute_force(spark, tile_rows):
    rows, df = table(spark)
    got = {r.vec_id: r for r in neardup.near_duplicates(df.repartition(6), tile_rows=tile_rows).collect()}
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    cos = (x @ x.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1))
    label = np.array([r[2] for r in rows])
    link = (cos >= 0.93) & (label[:, None] == label) & ~np.eye(len(x), dtype=bool)
    assert {i: got[r[0]].n_links for i, r in enumerate(rows)} == dict(enumerate(link.sum(1).tolist()))
    root = list(range(len(x)))
    for _ in x:
        root = [min([root[i], *(root[j] for j in np.flatnonzero(link[i]))]) for i in range(len(x))]
    assert [got[r[0]].component_id for r in rows] == [rows[r][0] for r in root]
    for i, _, _ in ODD:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_nearest_neighbours(spark):
    rows, df = table(spark, 700)
    got = {}
    for r in nearest.search(df, df.where("vec_id % 7 = 0"), dims=8, confidence=0.99, block_rows=150,
                            query_rows=40).collect():
        assert r.verified < len(rows)
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    ids = np.array([r[0] for r in rows])
    hits = total = 0
    for q in ids[ids % 7 == 0]:
        v = x[q]
        cos = (x * v).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((v * v).sum()))
        want = [i for i in ids[np.lexsort((ids, -cos))] if i != q][:5]
        found = [i for _, i, _ in sorted(got[q])]
        assert [r for r, _, _ in sorted(got[q])] == [1, 2, 3, 4, 5]
        assert all(s == cos[i] for _, i, s in got[q])
        hits, total = hits + len(set(want) & set(found)), total + 5
        assert not set(found) & {o[0] for o in ODD if o[0] not in (9006, 9007)}
    assert set(got) >= set(ids[ids % 7 == 0].tolist())
    assert hits / total >= 0.97


def test_chi_square():
    assert nearest.chi_square_quantile(0.95, 2) == pytest.approx(5.991, abs=1e-3)
    assert nearest.chi_square_quantile(0.99, 12) == pytest.approx(26.217, abs=1e-3)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables are not here")
def test_recall_on_the_table(spark):
    d = "/root/testdata/sf0.1"
    pdf = spark.read.parquet(f"{d}/embeddings.parquet").toPandas()
    x = np.stack(pdf["embedding"].to_list()).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = pdf["vec_id"].to_numpy()
    got = QUERIES["op7_nearest_neighbours"](spark, d).toPandas().groupby("query_id")["vec_id"].apply(set)
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        cos = x @ x[q]
        cos[q] = -2
        hits += len(set(ids[np.argsort(-cos)[:5]]) & got[ids[q]])
    assert hits / (5 * len(got)) >= 0.9


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables are not here")
def test_stopping_test_leaves_vectors_closed(spark):
    """About half of the cosines are worked out, with one block and with several."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    n = df.count()
    for block_rows in (16_384, 500):
        got = nearest.search(df, df.where("vec_id % 50 = 0"), block_rows=block_rows).where("rank = 1").toPandas()
        assert 0.2 < (got["verified"] / n).mean() < 0.7


def test_search_equals_plain_scan_where_the_test_never_fires():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((700, 10))
    x[100:140] = x[5]
    ids = rng.permutation(700)
    index = nearest.Index(ids, x, 4, 0)
    for q in (5, 120, 300):
        cos = (x * x[q]).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((x[q] * x[q]).sum()))
        others = [i for i in np.lexsort((ids, -cos)) if i != q][:5]
        found, scores, verified = index.search(int(ids[q]), x[q], 5, 1e12)
        assert found.tolist() == ids[others].tolist() and scores.tolist() == cos[others].tolist()
        again = index.search(int(ids[q]), x[q], 5, 1e12, bound=float(scores[-1]))
        assert again[0].tolist() == found.tolist()


def test_queries_that_repeat_an_id(spark):
    """They are one query; vectors that repeat an id stay apart."""
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.1, 1.0]), (2, [1.0, 0.2]), (3, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "0 as block", "1 as role")
    got = nearest.search(df, df.where("vec_id = 1"), dims=2, confidence=0.9999).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [3, 2, 2]


def test_empty(spark):
    _, df = table(spark, 10)
    assert neardup.near_duplicates(df.where("false")).count() == 0
    assert nearest.search(df.where("false"), df.where("false")).count() == 0
    assert nearest.search(df, df.where(F.col("vec_id") == 9001)).count() == 0
