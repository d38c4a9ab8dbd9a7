import re

import pytest
from pyspark.sql import functions as F

from trendcast.llm import mixing


def water_fill(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > limit * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        target |= {s: limit * sizes[s] for s in over}
        left -= sum(limit * sizes[s] for s in over)
        free -= over
    return target


def rows(n=400):
    out = [(i, "w " * (i * 37 % 91), ["a", "b", None, "ü", "hot", "hot", "hot"][i % 7]) for i in range(n)]
    return out + [(0, "one two", "a"), (0, "one two", "a"), (None, "x y z", "b"), (5, None, None), (6, "", "b"), (7, "v " * 5000, "ü")]


@pytest.fixture(scope="module")
def mixed(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, source string").selectExpr(
        "*", "1 as size", "2 as target", "3 as block", "4 as m_place")
    places = mixing.prepared(docs)
    return docs, places, mixing.mix(places, block_words=64, shard_blocks=16)


def test_targets_and_taken(mixed):
    docs, places, mixture = mixed
    got = mixing.taken(places, mixture).join(places.select("doc_id", "source").distinct(), "doc_id", "left")
    sizes = {}
    for _, text, source in rows():
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = water_fill(sizes)
    per_row = mixing.taken(places, mixture)
    assert per_row.count() == len(rows())
    assert per_row.where("taken not in (0, size, 2 * size)").count() == 0
    words = {r.source: r.words for r in mixture.groupBy("source").agg(F.sum("size").alias("words")).collect()}
    biggest = {s: max(len((t or "").split()) for _, t, x in rows() if x == s) for s in sizes}
    for r in places.select("source", "source_size", "target").distinct().collect():
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert abs(words.get(r.source, 0) - r.target) <= biggest[r.source] / 2 + 1
    assert got.count() >= len(rows())


def test_shards_are_disjoint_and_complete(mixed):
    _, places, mixture = mixed
    drawn = mixture.groupBy("source_no", "block").agg(F.countDistinct("shard").alias("n"))
    assert drawn.where("n > 1").count() == 0
    copies = mixture.groupBy("source_no", "slice_no", "row_no", "pass").count()
    assert copies.where("count > 1").count() == 0
    per_shard = mixture.groupBy("shard").agg(F.count("*").alias("n"), F.max("position").alias("last"))
    assert per_shard.where("n != last").count() == 0


def test_tree_gives_exact_quotas_and_even_shards(spark):
    quotas = spark.createDataFrame([(1, 700), (2, 1), (3, 299), (4, 37)], "source_no long, quota long")
    dealt = mixing.deal(quotas, 13, 1037, seed=3).cache()
    by_source = {r.source_no: r.n for r in dealt.groupBy("source_no").agg(F.sum("blocks").alias("n")).collect()}
    assert by_source == {1: 700, 2: 1, 3: 299, 4: 37}
    shards = [r.n for r in dealt.groupBy("shard").agg(F.sum("blocks").alias("n")).collect()]
    assert len(shards) == 13 and max(shards) - min(shards) <= 1
    dealt.unpersist()


def test_hypergeometric_distribution(spark):
    df = spark.range(20000).select(mixing.hypergeometric(
        F.lit(50), F.lit(20), F.lit(30), mixing.uniform(F.lit(1), F.col("id"))).alias("x"))
    r = df.agg(F.avg("x").alias("m"), F.var_samp("x").alias("v"), F.min("x").alias("a"), F.max("x").alias("b")).first()
    assert r.m == pytest.approx(12, abs=0.06)
    assert r.v == pytest.approx(30 * 0.4 * 0.6 * 20 / 49, rel=0.05)
    assert 0 <= r.a and r.b <= 20


def test_reruns_agree_and_documents_repeat(mixed, spark):
    docs, _, _ = mixed
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    a = sorted((str(r.doc_id), r.text or "") for r in out.collect())
    b = sorted((str(r.doc_id), r.text or "") for r in mixing.mixed_documents(docs.repartition(3)).collect())
    assert a == b and len(a) > 300


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    places = mixing.prepared(docs)
    assert mixing.taken(places, mixing.mix(places)).count() == 0
    assert mixing.mixed_documents(docs).count() == 0


def test_extra_columns_may_have_any_name(spark):
    names = ["m_digest", "m_name", "m_no", "m_places", "digest", "name", "no", "places", "place", "row"]
    docs = spark.createDataFrame(rows(60), "doc_id long, text string, source string").select(
        "*", *[F.lit(c).alias(c) for c in names])
    got = mixing.mixed_documents(docs, block_words=64, shard_blocks=8)
    assert got.columns == docs.columns
    plain = mixing.mixed_documents(docs.select("doc_id", "text", "source"), block_words=64, shard_blocks=8)
    found = got.collect()
    assert all(list(r)[3:] == names for r in found)
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in plain.collect())
