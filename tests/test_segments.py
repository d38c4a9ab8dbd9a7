import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tests.fixtures import rows
from trendcast.operators import segment, segmented, textvec

SMALL = dict(k_values=(2, 3), restarts=2, period="year")


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(7)
    data = [(i, i % 3, [10.0 * (i % 3) + rng.gauss(0, 1), rng.gauss(0, 1)]) for i in range(90)]
    return spark.createDataFrame(data, "id int, label int, v array<double>").persist()


def brute_silhouette(points, labels, power=1):
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1)) ** power
    out = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            out.append(0.0)
            continue
        a = d[i][mine].sum() / (mine.sum() - 1)
        b = min(d[i][labels == c].mean() for c in set(labels) if c != own)
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_silhouettes_match_brute_force(spark, blobs):
    extra = spark.createDataFrame([(999, 9, [50.0, 50.0])], "id int, label int, v array<double>")
    df = blobs.unionByName(extra)
    local = df.toPandas()
    points, labels = np.array(local["v"].tolist()), local["label"].to_numpy()
    (exact,) = rows(segment.silhouette_scores(df, "v", ["label"]), "silhouette")
    assert exact[0] == pytest.approx(brute_silhouette(points, labels))
    (squared,) = rows(segment.silhouette_squared(df, "v", "label"), "silhouette")
    assert squared[0] == pytest.approx(brute_silhouette(points, labels, 2))


def test_silhouette_of_one_cluster_is_undefined(blobs):
    one = blobs.withColumn("same", F.lit(1))
    assert rows(segment.silhouette_scores(one, "v", ["same"]), "silhouette") == [(None,)]


def test_silhouette_over_many_tiles_uses_all_rows(spark):
    rng = np.random.default_rng(5)
    points, labels = rng.normal(size=(700, 3)), rng.integers(0, 4, 700)
    df = spark.createDataFrame([(x.tolist(), int(c), "one") for x, c in zip(points, labels)], "v array<double>, c int, s string")
    got = dict(rows(segment.silhouette_scores(df, "v", ["c", "s"], tile_rows=60), "labelling", "silhouette"))
    assert got["c"] == pytest.approx(brute_silhouette(points, labels)) and got["s"] is None


def test_silhouette_shuffles_rows_and_sums_only(spark, monkeypatch):
    """Copies count, sums of many clusters meet in buckets, and a pair of tiles is no shuffled row."""
    rng = np.random.default_rng(6)
    points, labels = rng.normal(size=(700, 3)), rng.integers(0, 40, 700)
    points, labels = np.vstack([points, points[:300]]), np.append(labels, labels[:300])
    df = spark.createDataFrame([(x.tolist(), int(c), int(c) % 3) for x, c in zip(points, labels)], "v array<double>, c int, s int")
    monkeypatch.setattr(segment, "BUCKET_CLUSTERS", 7)
    monkeypatch.setattr(segment, "RUN_BYTES", 4000)
    seen = []
    mapped = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *a, **k: (seen.append(self), mapped(self, *a, **k))[1])
    got = dict(rows(segment.silhouette_scores(df, "v", ["c", "s"], tile_rows=300), "labelling", "silhouette"))
    assert got["c"] == pytest.approx(brute_silhouette(points, labels))
    assert got["s"] == pytest.approx(brute_silhouette(points, labels % 3))
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" in plan and "strategy=shuffle_replicate_nl" in plan


def test_far_rows_meet_through_nodes(spark, monkeypatch):
    """In few dimensions only near boxes meet row by row, and silhouettes are those of all pairs."""
    rng = np.random.default_rng(8)
    points = np.column_stack([rng.lognormal(size=5000), 0.1 * rng.normal(size=5000), 5.0 * rng.integers(0, 2, 5000)])
    points = np.vstack([points, points[:50]])
    labels = np.where(points[:, 0] > 3, 7, (points[:, 1] > 0.02).astype(int))
    labels[60] = 9
    df = spark.createDataFrame([(x.tolist(), int(c), int(c) % 2) for x, c in zip(points, labels)], "v array<double>, c int, s int")
    seen = []
    look = segment._far_tiles
    monkeypatch.setattr(segment, "_far_tiles", lambda packed: seen.append(look(packed)) or seen[-1])
    got = dict(rows(segment.silhouette_scores(df, "v", ["c", "s"], tile_rows=128), "labelling", "silhouette"))
    assert seen[0].apart.mean() > 0.5
    assert got["c"] == pytest.approx(brute_silhouette(points, labels), abs=1e-9)
    assert got["s"] == pytest.approx(brute_silhouette(points, labels % 2), abs=1e-9)


def test_rows_of_many_dimensions_all_meet(spark):
    rng = np.random.default_rng(9)
    points, labels = rng.normal(size=(1300, 5)), rng.integers(0, 3, 1300)
    df = spark.createDataFrame([(x.tolist(), int(c)) for x, c in zip(points, labels)], "v array<double>, c int")
    got = dict(rows(segment.silhouette_scores(df, "v", ["c"], tile_rows=64), "labelling", "silhouette"))
    assert got["c"] == pytest.approx(brute_silhouette(points, labels), abs=1e-9)


def test_sample_is_exact_and_stable(blobs):
    a = {r for r in rows(segment.stable_sample(blobs, "id", 20, 1), "id")}
    b = {r for r in rows(segment.stable_sample(blobs.repartition(5), "id", 20, 1), "id")}
    assert a == b and len(a) == 20
    assert a != {r for r in rows(segment.stable_sample(blobs, "id", 20, 2), "id")}


def test_choose_k_finds_the_blobs(blobs):
    out = segment.choose_k(blobs, "v", k_values=(2, 3, 4), restarts=3)
    assert out.first()["k"] == 3 and all(-1 <= s <= 1 for (s,) in rows(out, "silhouette_score"))


def test_restarts_never_raise_the_cost(blobs):
    v = blobs.select(array_to_vector("v").alias("features")).persist()
    cost = lambda seeds: segment.fit_kmeans(v, 3, seeds).summary.trainingCost
    assert cost([1, 2, 3]) <= min(cost([s]) for s in (1, 2, 3)) + 1e-9


def test_starts_share_the_passes(blobs, monkeypatch):
    v = blobs.select("id", array_to_vector("v").alias("features")).persist()
    passes = []
    one = segment.kmeans._pass
    monkeypatch.setattr(segment.kmeans, "_pass", lambda blocks, fits: passes.append(len(fits)) or one(blocks, fits))
    model = segment.fit_kmeans(v, 3, range(6))
    assert passes[0] == passes[-1] == 6  # of the first iteration, and of the costs at the end
    got = model.transform(v).collect()
    centres = np.array(model.clusterCenters())
    assert [r.cluster for r in got] == [int(((centres - r.features.toArray()) ** 2).sum(1).argmin()) for r in got]
    cost = sum(((centres[r.cluster] - r.features.toArray()) ** 2).sum() for r in got)
    assert model.summary.trainingCost == pytest.approx(cost)
    with pytest.raises(ValueError, match="no rows"):
        segment.fit_kmeans(v.limit(0), 3, range(2))


def test_scaler_leaves_a_constant_unscaled(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    full = spark.createDataFrame([(3.0, 7.0), (None, 5.0)], "a double, c double")
    out = segment.fit_scaler(train, ["a", "c"]).transform(full)
    assert rows(out, "scaled") == [([1.0, 2.0],), ([-2.0, 0.0],)]


def test_nearest_centroid(blobs):
    out = segment.nearest_centroid(blobs, "v", segment.centroids(blobs, "v", "label"), "label")
    assert out.filter("label <> nearest").count() == 0 and out.count() == 90


def test_balance_profile_and_smallest(spark):
    data = [("a", 2000, 3, 1, 0), ("a", 2001, 4, 0, 1), ("b", 2010, 8, 1, 1), ("a", 2004, 5, 0, 0)]
    df = spark.createDataFrame(data, "c string, year int, words int, kw_x int, kw_y int")
    balance = segment.segment_balance(df, "c", "s")
    assert rows(balance, "scheme", "cluster", "n", "share") == [("s", "a", 3, 0.75), ("s", "b", 1, 0.25)]
    assert rows(segment.smallest_segment(balance), "scheme", "cluster", "share") == [("s", "b", 0.25)]
    p = segment.segment_profile(df, "c", "year", {"avg_words": ("words", 2)}, ["kw_x", "kw_y", "kw_z"])
    assert rows(p, "cluster", "n", "share", "avg_period", "avg_words", "dominant_flag") == [
        ("a", 3, 0.75, 2001.67, 4.0, "kw_x"), ("b", 1, 0.25, 2010.0, 8.0, "kw_x")]


TITLES = ["radio antenna array", "antenna array feed", "radio antenna feed", "cloud data service", "data service mesh",
          "cloud service mesh"]


@pytest.fixture(scope="module")
def titles(spark):
    data = [(i, 2000 + i % 4, TITLES[i % 6], int(i % 6 < 3), int(i % 6 >= 3), 3) for i in range(48)]
    return spark.createDataFrame(data, "id int, year int, title string, kw_a int, kw_b int, words int").persist()


def test_terms_are_unicode_words_without_stop_words(spark):
    df = spark.createDataFrame([("Méthod of the A 5G x_1!",), (None,)], "t string")
    out = rows(textvec.add_terms(df, "t"), "terms")
    assert out == [(["méthod", "5g", "x_1", "méthod 5g", "5g x_1"],), ([],)]


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([(1, "cat cat dog"), (2, "dog bird"), (3, "dog cat")], "id int, t string")
    terms = textvec.add_terms(df, "t", stop_words=[], max_n=1)
    model = textvec.fit_tfidf(terms, 1, 10)
    assert model.vocabulary == ("bird", "cat", "dog")
    got = {(i, t): w for i, t, w in rows(textvec.vector_entries(model.transform(terms), model, ["id"]), "id", "term", "weight")}
    cat, dog = 2 * (math.log(4 / 3) + 1), math.log(4 / 4) + 1
    assert got[1, "cat"] == pytest.approx(cat / math.hypot(cat, dog)) and got[1, "dog"] == pytest.approx(dog / math.hypot(cat, dog))
    assert textvec.fit_tfidf(terms, 3, 10) is None


def test_words_are_counted_as_their_grams_would_be(spark, monkeypatch):
    """Batches of words give the counts and vectors of the arrays of n-grams, and each term leaves a task once."""
    rng = random.Random(8)
    vocabulary = "aa bb cc dd the élan ff".split()
    texts = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 9])))) for i in range(80)] + [(99, None)]
    df = spark.createDataFrame(texts, "id int, t string").coalesce(1)
    for n in (1, 2, 3):
        terms, words = textvec.add_terms(df, "t", ["THE", "bb"], n), textvec.add_words(df, "t")
        every = textvec.term_statistics(terms)
        counted = textvec.term_statistics(words, "words", ["THE", "bb"], n)
        plain = terms.select("id", F.explode("terms").alias("term")).groupBy("term").agg(
            F.count("*").alias("tf"), F.countDistinct("id").alias("df"))
        expected = sorted(rows(plain, "term", "tf", "df"))
        assert sorted(rows(every, "term", "tf", "df")) == sorted(rows(counted, "term", "tf", "df")) == expected
        model = textvec.fit_tfidf(words, 2, 30, "words", ["THE", "bb"], n)
        got = {r.id: dict(zip(r.indices, r.values)) for r in model.parts(words, "id").collect()}
        vectors = {r.id: r.tfidf for r in model.transform(words).select("id", "tfidf").collect()}
        assert set(got) == set(vectors) and all(
            got[i] == pytest.approx(dict(zip(v.indices.tolist(), v.values.tolist()))) for i, v in vectors.items())
        means = dict(rows(textvec.mean_weights(model.parts(words, "id"), "id", len(model.vocabulary)), "id", "mean"))
        assert all(means[i] == pytest.approx(v.toArray().tolist()) for i, v in vectors.items())
    monkeypatch.setattr(textvec, "PIECE_WORDS", 10)
    lists = pa.array([["a"] * 9, None, ["b"] * 30, [], ["c"]])
    assert pa.concat_arrays(list(textvec._pieces(lists))).equals(lists) and len(list(textvec._pieces(lists))) == 2


def test_ngrams_of_rare_words_are_not_counted_and_not_missed(spark, monkeypatch):
    rng = random.Random(9)
    vocabulary = [f"w{i:02d}" for i in range(60)]
    texts = [(i, " ".join(rng.choices(vocabulary, [1 / (1 + j) for j in range(60)], k=25))) for i in range(120)]
    words = textvec.add_words(spark.createDataFrame(texts, "id int, t string"), "t")
    for n, options in ((2, [(3, 20)]), (3, [(3, 40), (10, 15)]), (2, [(2, 500)])):
        every = textvec.term_statistics(words, "words", ["w01"], n)
        some = textvec.frequent_statistics(words, options, "words", ["w01"], n).persist()
        for option in options:
            assert rows(textvec.choose_vocabulary(some, *option), "term", "tf", "df") == rows(
                textvec.choose_vocabulary(every, *option), "term", "tf", "df")
        assert (some.count() < every.count()) == (options[0][1] < 60)
    monkeypatch.setattr(textvec, "MOST_WORDS", 5)
    assert textvec.frequent_statistics(words, [(3, 20)], "words", [], 2).count() == textvec.term_statistics(
        words, "words", [], 2).count()


def test_a_large_file_is_not_dealt_out_again(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(f"{rng.getrandbits(60):x}" for _ in range(600)) for _ in range(800)]
    for name, group in (("many", 100), ("one", 800)):
        pq.write_table(pa.table({"id": list(range(800)), "t": texts}), tmp_path / f"{name}.parquet", row_group_size=group)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        many, one = (spark.read.parquet(str(tmp_path / f"{n}.parquet")) for n in ("many", "one"))
        assert textvec.dealt_out(many) is many  # one file, read by many tasks
        assert textvec.dealt_out(one).select(F.spark_partition_id()).distinct().count() == 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_options_share_one_reading_of_the_texts(spark, monkeypatch):
    rng = random.Random(5)
    texts = [(i, None if i == 7 else " ".join(rng.choice(["aa", "bb", "cc", "dd", "ee"]) for _ in range(i % 9))) for i in range(60)]
    words = textvec.add_words(spark.createDataFrame(texts, "id int, t string"), "t")
    models = [textvec.fit_tfidf(words, 1, n, "words", ["dd"], 2) for n in (4, 9)]
    every = sorted({term for m in models for term in m.vocabulary})
    counted = textvec.term_rows(words, every, "words", ["dd"], 2, "id")
    for m in models:
        got = dict(rows(textvec.mean_weights(m.weighted(counted, every, "id"), "id", len(m.vocabulary)), "id", "mean"))
        for r in m.transform(words).collect():
            assert got[r.id] == pytest.approx(r.tfidf.toArray())
    read = []
    monkeypatch.setattr(segment, "term_rows", lambda *args: read.append(args) or textvec.term_rows(*args))
    grid = [{"min_df": 1, "max_features": n, "svd_components": 2} for n in (4, 9)]
    segment.text_segmentation(words.withColumn("year", F.col("id")), words.withColumn("year", F.col("id")), "t", "id", grid, **SMALL)
    assert len(read) == 1


def test_vocabulary_ranks_by_corpus_count_then_term(spark):
    df = spark.createDataFrame([(["b", "b", "a"],), (["a", "c"],)], "terms array<string>")
    stats = textvec.term_statistics(df)
    assert sorted(rows(stats, "term", "tf", "df")) == [("a", 2, 2), ("b", 2, 1), ("c", 1, 1)]
    assert rows(textvec.choose_vocabulary(stats, 1, 2), "term") == [("a",), ("b",)]


def test_svd_matches_numpy(spark):
    rng = random.Random(3)
    texts = [(i, " ".join(rng.choices("aa bb cc dd ee ff gg".split(), [9, 7, 5, 4, 3, 2, 1], k=6))) for i in range(60)]
    terms = textvec.add_terms(spark.createDataFrame(texts, "id int, title string"), "title", stop_words=[])
    tfidf = textvec.fit_tfidf(terms, 1, 50)
    vectors = tfidf.transform(terms).persist()
    model = textvec.fit_svd(vectors, 3, len(tfidf.vocabulary))
    x = np.array([r["tfidf"].toArray() for r in vectors.orderBy("id").select("tfidf").collect()])
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    got = np.array([r["reduced"] for r in model.transform(vectors).orderBy("id").select("reduced").collect()])
    assert np.abs(got) == pytest.approx(np.abs(x @ vt[:3].T), abs=1e-6)
    assert model.explained_variance == pytest.approx(np.var(x @ vt[:3].T, axis=0).sum() / np.var(x, axis=0).sum(), abs=1e-6)


def test_top_terms_skip_zero_weights_and_break_ties(spark):
    df = spark.createDataFrame([("g", [0.5, 0.5, 0.0]), ("h", [0.0, 0.1, 0.3])], "g string, w array<double>")
    model = textvec.TfidfModel(("x", "y", "z"), (1.0, 1.0, 1.0))
    out = df.select("g", textvec.top_terms(array_to_vector("w"), model, 2).alias("t"))
    assert dict(rows(out, "g", "t")) == {"g": "y, x", "h": "z, y"}


def test_centres_are_met_in_blocks(blobs, monkeypatch):
    centres = segment.centroids(blobs, "v", "label")
    nearest = sorted(rows(segment.nearest_centroid(blobs, "v", centres, "label"), "id", "nearest"))
    (whole,) = rows(segment.silhouette_squared(blobs, "v", "label"), "silhouette")
    monkeypatch.setattr(segment, "CENTRE_BLOCK", 1)
    assert sorted(rows(segment.nearest_centroid(blobs, "v", centres, "label"), "id", "nearest")) == nearest
    (split,) = rows(segment.silhouette_squared(blobs, "v", "label"), "silhouette")
    assert split[0] == pytest.approx(whole[0])



def test_text_segmentation(titles):
    grid = [{"min_df": 2, "max_features": 20, "svd_components": 3}, {"min_df": 1000, "max_features": 20, "svd_components": 3}]
    train = titles.filter("year <= 2002")
    r = segment.text_segmentation(train, titles, "title", "id", grid, means={"avg_words": ("words", 2)}, flags=["kw_a", "kw_b"], **SMALL)
    assert r.assigned.count() == 48 and r.sensitivity.count() == 1
    groups = {frozenset(i % 6 < 3 for (i,) in rows(r.assigned.filter(F.col("text_cluster") == c), "id"))
              for (c,) in rows(r.assigned.select("text_cluster").distinct(), "text_cluster")}
    assert all(len(g) == 1 for g in groups)
    assert sum(n for (n,) in rows(r.profile, "n")) == 48 and all("," in t for (t,) in rows(r.profile, "top_terms"))
    first = r.selection.first()
    assert first["selected_k"] == first["k"] and first["fit_end"] == 2002
    with pytest.raises(ValueError, match="two or more terms"):
        segment.text_segmentation(train, titles, "title", "id", grid[1:], **SMALL)


def test_numeric_segmentation_is_fitted_on_training_rows_only(titles):
    train = titles.filter("year <= 2001")
    r = segment.numeric_segmentation(train, titles, ["kw_a", "kw_b", "words"], "id", flags=["kw_a", "kw_b"], **SMALL)
    assert r.selection.first()["k"] == 2 and r.selection.first()["fit_end"] == 2001
    assert {(k, n) for k, n in rows(r.profile, "dominant_flag", "n")} == {("kw_a", 24), ("kw_b", 24)}


def test_limitations(spark):
    totals = spark.createDataFrame([(1, 2), (2, 3)], "period int, n int")
    scores = spark.createDataFrame([(2, 0.5), (3, 0.25)], "k int, silhouette_score double")
    small = spark.createDataFrame([("b", "y", 0.1), ("a", "x", 0.2)], "scheme string, cluster string, share double")
    out = dict(rows(segmented.limitations(totals, {"text": scores}, small, 5), "theme", "evidence"))
    assert out == {"sample_size": "2 periods available", "recursive_forecasting": "horizon of 5 periods",
                   "text_separation": "best silhouette 0.5000", "cluster_imbalance": "a: x 0.2000; b: y 0.1000"}


def test_tiles_go_to_python_in_small_batches_and_once(spark, monkeypatch):
    rng = np.random.default_rng(8)
    points, labels = rng.normal(size=(900, 20)), rng.integers(0, 3, 900)
    df = spark.createDataFrame([(x.tolist(), int(c)) for x, c in zip(points, labels)], "v array<double>, c int")
    seen = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(segment, "PAIR_BYTES", 60_000)
    whole = segment._distance_sums

    def watched(batches, buckets):
        def look():
            for batch in batches:
                # A tile has 16 kB; its own vectors come with its first pair only, so batches of 60 kB have few of them.
                assert batch.num_rows <= 10 and batch.nbytes < 150_000
                seen.add(sum(x.is_valid for x in batch.column(1)))
                yield batch
        return whole(look(), buckets)

    monkeypatch.setattr(segment, "_distance_sums", watched)
    (got,) = rows(segment.silhouette_scores(df, "v", ["c"], tile_rows=100), "silhouette")
    assert got[0] == pytest.approx(brute_silhouette(points, labels))
    assert seen.value == 9
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None
