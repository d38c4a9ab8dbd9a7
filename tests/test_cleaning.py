import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.fixtures import rows
from trendcast.functions.coerce import finite
from trendcast.operators import cleaning

RAW = [
    ("a", "31/12/2010", "2010", "1", 1), ("a", "01/01/2011", "2011", "0", 2), ("b", "not a date", "2010.7", "0.5", 3),
    ("c", "03/01/1969", "1969", "2", 4), ("d", "02/03/2010", "2035", "-1", 5), ("e", None, "abc", "1", 6),
    ("f", "05/06/2012", "2012", "NaN", 7), ("g", "05/06/2013", "2013", "0.7", 8),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(RAW, "` Patent_ID ` string, Patent_Date string, YEAR string, KW_5G string, seq int")


def test_cleaning_chain(raw):
    clean = cleaning.clean_events(raw, ["kw_5g"], "patent_id", ["seq"], ["patent_date"])
    assert rows(clean.orderBy("seq"), "patent_id", "patent_date", "year", "kw_5g") == [
        ("a", dt.date(2010, 12, 31), 2010, 1), ("b", None, 2010, 0), ("d", dt.date(2010, 3, 2), 2035, 0),
        ("f", dt.date(2012, 6, 5), 2012, 0), ("g", dt.date(2013, 6, 5), 2013, 1)]


def test_first_duplicate_wins_even_if_it_is_dropped_later(spark):
    df = spark.createDataFrame([("x", "1900", 1), ("x", "2000", 2)], "patent_id string, year string, seq int")
    assert cleaning.clean_events(df, [], "patent_id", ["seq"], ["patent_date"]).count() == 0


def test_null_ids_are_one_id_and_hot_ids_collapse(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), *[("hot", i) for i in range(2, 500)]], "id string, seq int")
    assert sorted(rows(cleaning.keep_first(df, "id", ["seq"]), "seq")) == [(1,), (2,)]


def test_dedup_keeps_whole_rows_without_a_window(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "late", 6)], "id int, note string, seq int")
    out = cleaning.keep_first(df, "id", ["seq"])
    assert out.columns == df.columns and rows(out, "note") == [(None,)]
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_rows_collapse_when_the_id_is_absent(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "a int, b int")
    assert cleaning.keep_first(df, "id").count() == 2


@pytest.mark.parametrize("text, flag", [
    ("0.5", 0), ("0.7", 1), ("2", 1), ("-1", 0), ("x", 0), ("NaN", 0), (None, 0), ("inf", 1), ("1d", 0), (" 1 ", 1)])
def test_flag_values(spark, text, flag):
    df = spark.createDataFrame([(text,)], "f string")
    assert rows(cleaning.coerce_flags(df, ["f", "absent"]), "f") == [(flag,)]


def test_flag_on_doubles_maps_nan_to_zero(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.5,)], "f double")
    assert rows(cleaning.coerce_flags(df, ["f"]), "f") == [(0,), (1,), (1,)]


def test_date_formats_are_tried_in_order(spark):
    df = spark.createDataFrame([("3/1/2010",), ("2010-03-01",)], "patent_date string")
    day_first = cleaning.convert_types(df, ["patent_date"])
    assert rows(day_first, "patent_date") == [(dt.date(2010, 1, 3),), (None,)]
    both = cleaning.convert_types(df, ["patent_date"], formats=["d/M/yyyy", "yyyy-MM-dd"])
    assert rows(both, "patent_date")[1] == (dt.date(2010, 3, 1),)


def test_names_that_collide_are_an_error(spark):
    with pytest.raises(ValueError, match="collide"):
        cleaning.standardise_names(spark.createDataFrame([(1, 2)], "`A ` int, a int"))


def test_null_profile_counts_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (None, "y"), (2.0, "z")], "v double, s string")
    assert rows(cleaning.null_profile(df), "column", "missing_count", "missing_pct") == [("v", 2, 50.0), ("s", 1, 25.0)]


def test_finite(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (5.0,)], "v double")
    assert rows(df.withColumn("v", finite(F.col("v"), 1e6)), "v") == [(0.0,), (1e6,), (-1e6,), (0.0,), (5.0,)]


def test_keep_first_with_maps_ties_and_a_hot_id(spark):
    data = [(1, k % 7, {"a": k}) for k in range(300)] + [(2, 5, {"b": 1}), (None, 2, None), (None, 1, {"c": 3})]
    df = spark.createDataFrame(data, "id int, seq int, m map<string,int>").repartition(5)
    out = cleaning.keep_first(df, "id", ["seq"])
    assert sorted(rows(out, "id", "seq"), key=str) == [(1, 0), (2, 5), (None, 1)]
    assert "SortAggregate" not in df.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()


def test_fill_missing(spark):
    df = spark.createDataFrame([(None, None, None)], "c string, t string, n double")
    out = cleaning.fill_missing(df, ["c"], ["t"], ["n"])
    assert rows(out, "c", "t", "n") == [("missing", "", 0.0)]


def test_missing_period_column_is_tolerated(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert cleaning.valid_periods(df).count() == 1
    assert cleaning.convert_types(df, ["d"]).select(F.col("a")).count() == 1
