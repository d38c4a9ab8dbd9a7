import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trendcast.llm.shared import written

TABLES = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="test tables are not here")
def test_stages(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns, seen = docs.dtypes, []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, TABLES), "stage")
        seen.append((name, before.count(), docs.count()))
        if name != "best-fit packing":
            assert docs.dtypes == columns
            assert docs.join(before, "doc_id", "left_anti").count() == 0
        if name == "simhash near-dedup":
            assert docs.groupBy("doc_id").count().where("count > 1").count() == 0
        if name == "source mixing":
            assert docs.groupBy("doc_id").count().where("count > 2").count() == 0
    assert all(after > 0.5 * before for _, before, after in seen[:3])
    totals = docs.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert totals.where("n > 4096").count() == 0


def test_empty_and_null_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in ([], [(1, None, None, None, None), (None, "a b\na b", "en", "s", 7), (2, "", "en", "s", 0)]):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, str(tmp_path)), "stage")
        assert docs.count() <= 2 * len(rows)


def test_repeated_ids_leave_one_row_for_each_group(spark):
    rng = random.Random(7)
    a, b, c, d = (" ".join(f"w{rng.randrange(900)}" for _ in range(200)) for _ in range(4))
    rows = [(1, a), (1, a), (1, b), (0, b), (1, c), (2, c), (None, d), (None, d), (3, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.selectExpr("*", "'x' as k_id", "1 as id", "2 as no", "3 as __row", "4 as row", "5 as root", "6 as fp")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    got = sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str)
    assert got == sorted([(1, a), (0, b), (1, c), (None, d), (3, "")], key=str)
    assert kept.dtypes == docs.dtypes
