import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from trendcast.llm import language, toxicity
from trendcast.llm.queries import QUERIES
from trendcast.llm.sql import SQL
from tests.compare import connect, difference

TABLES = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(TABLES), reason="test tables are not here")


@here
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    assert difference(spark, connect(TABLES), name, TABLES) == ""


def labelled(seed=1, n=900):
    rng = random.Random(seed)
    plain = ["".join(rng.choice(["an", "the", "er", "ion", "ou", "sh", "ti"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    bad = ["moron", "worthless", "pathetic", "idiot", "scumbag"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = [rng.choice(plain) for _ in range(rng.randint(20, 120))]
        for _ in range(len(words) // 12 + 1 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity(spark, tmp_path):
    docs, labels = labelled()
    docs += [(5000, None), (5001, ""), (None, "x"), (5002, "idiot " * 60_000), (0, docs[0][1])]
    labels += [(5000, None), (None, 1), (5000, 1), (7777, 0)]
    spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "2 as toxic").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = QUERIES["op2_toxicity"](spark, str(tmp_path)).collect()
    assert len(rows) == len(docs)
    truth = dict(labels[:900])
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows if r.doc_id is not None)
    hits = [r.predicted for r in held if truth[r.doc_id]]
    assert sum(hits) >= 0.9 * len(hits)
    assert sum(r.predicted for r in held if not truth[r.doc_id]) <= 0.01 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_toxicity_reads_whole_runs_without_white_space():
    rng = random.Random(5)
    run = "".join(rng.choice("bcdfghklmn") for _ in range(3000))
    found = toxicity.windows(f"a word, {run}")
    assert found[0] == "word" and max(map(len, found)) <= toxicity.LONGEST
    parts = found[1:]
    assert parts[0] + "".join(p[toxicity.OVERLAP:] for p in parts[1:]) == run
    assert toxicity.windows("x" * 513)[-1] == "x" * 65 and toxicity.windows("x" * 512) == ["x" * 512]

    docs, labels = labelled()
    truth = dict(labels)
    model = toxicity.fit_texts([t for i, t in docs if truth[i]], [t for i, t in docs if not truth[i]], 0.25)
    plain = [w for i, t in docs if not truth[i] for w in t.split()]
    safe = "".join(plain[:600])
    bad = safe[:2000] + "moronworthlesspatheticidiotscumbag" * 8 + safe[2000:]
    scorer = toxicity.Scorer(model)
    assert scorer.score(bad) > scorer.score(safe)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(1, None)], "doc_id long, toxic int"))
    assert model is None and toxicity.scores(docs, model).first().score == 0
    assert toxicity.scores(docs.where("false"), None).count() == 0


def test_forward_sums_all_segmentations():
    import numpy as np

    table = {"▁": 0.1, "▁a": 0.2, "a": 0.3, "b": 0.05, "ab": 0.15}
    vectors = {k: np.array([v, v / 2]) for k, v in table.items()}

    def slow(word, scale):
        if not word:
            return 1.0
        return sum(table[word[:k]] * scale * slow(word[k:], scale) for k in range(1, len(word) + 1) if word[:k] in table)

    got = np.exp(language.Forward(vectors, 2)(["aab", "b"]))[0]
    assert got == pytest.approx([slow("▁aab", 1), slow("▁aab", 0.5)])
    counts = language.expected_counts("aab", table, 2)
    assert sum(len(p) * n for p, n in counts.items()) == pytest.approx(4)
    assert np.isfinite(language.Forward(vectors, 2)(["ab" * 400, "zz", "z" * 60, ""])).all()


@here
def test_language(spark, tmp_path):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").unionByName(spark.createDataFrame(
        [(90001, None, None, None, None), (90002, "12 !?", "en", None, None), (90003, "the " * 90_000, None, None, None),
         (None, "the of and", "en", None, None)], "doc_id long, text string, lang string, source string, n_chars long"))
    docs.selectExpr("*", "1 as lang_pred").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op9_language_id"](spark, str(tmp_path))
    rows = {r.doc_id: r for r in got.collect()}
    assert got.count() == docs.count()
    assert rows[90001].lang_pred == rows[90002].lang_pred == "und" and rows[90003].lang_pred == "en"
    joined = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and doc_id < 90000")
    right = joined.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_language_without_training(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert [tuple(r) for r in language.predictions(docs, model).collect()] == [(1, "und", 0.0)]
    assert language.predictions(docs.where("false"), model).count() == 0
