"""Versioned hand-off, and the tally of date formats."""

import pytest
from pyspark.sql import functions as F

from tests.fixtures import rows
from trendcast.operators import cleaning
from trendcast.sources import handoff


@pytest.fixture
def events(spark):
    data = [(1, "01", "a b/c=d"), (2, "01", None), (3, "02", "x"), (4, None, "y"), (5, "02", "z")]
    return spark.createDataFrame(data, "id int, m string, note string")


def test_versions_round_trip_and_the_newest_is_read(spark, events, tmp_path):
    path = str(tmp_path / "clean")
    first = handoff.publish(events, path, "m")
    assert handoff.read_version(spark, path).schema == events.schema  # a period that looks like a number stays text
    second = handoff.publish(events.where("id > 2"), path, "m")
    assert sorted(rows(handoff.read_version(spark, path), "id", "m")) == [(3, "02"), (4, None), (5, "02")]
    assert sorted(map(tuple, handoff.read_version(spark, path, first).collect()), key=str) == sorted(
        map(tuple, events.collect()), key=str)
    assert dict(rows(handoff.manifest(spark, path, second), "period", "n")) == {"02": 2, None: 1}


def test_a_filter_on_the_period_prunes_folders(spark, events, tmp_path):
    path = str(tmp_path / "clean")
    handoff.publish(events, path, "m")
    cut = handoff.read_version(spark, path).where("m <= '01'")
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan
    assert sorted(rows(cut, "id")) == [(1,), (2,)]


def test_a_broken_write_is_not_read_and_damage_is_told(spark, events, tmp_path):
    path = str(tmp_path / "clean")
    with pytest.raises(ValueError):
        handoff.manifest(spark, path)
    kept = handoff.publish(events, path, "m")
    events.write.partitionBy("m").parquet(f"{path}/data/99999999999999999999-broken")
    assert handoff.read_version(spark, path).count() == 5
    assert handoff.damaged_periods(spark, path).isEmpty()
    with pytest.raises(ValueError):
        handoff.read_version(spark, path, "99999999999999999999-broken")
    events.where("m = '02'").drop("m").write.mode("append").parquet(f"{path}/data/{kept}/m=02")
    assert rows(handoff.damaged_periods(spark, path), "period", "n", "found") == [("02", 2, 4)]


def test_tally_of_formats(spark):
    df = spark.createDataFrame(
        [("01/02/2020", "2020-01-31", " "), ("31/12/2020", "12/31/2020", None), ("3/4/2021", "2020-05-05", "n/a"), (None, " ", "")],
        "a string, b string, c string")
    formats = ["d/M/yyyy", "M/d/yyyy", "yyyy-MM-dd"]
    tally = cleaning.date_format_tally(df, ["a", "b", "c", "absent"], formats)
    got = {(r["column_name"], r["format"]): tuple(r)[2:] for r in tally.collect()}
    assert got == {
        ("a", "d/M/yyyy"): (3, 3, 1, True), ("a", "M/d/yyyy"): (3, 2, 0, False), ("a", "yyyy-MM-dd"): (3, 0, 0, False),
        ("b", "d/M/yyyy"): (3, 0, 0, False), ("b", "M/d/yyyy"): (3, 1, 1, False), ("b", "yyyy-MM-dd"): (3, 2, 2, True),
        ("c", "d/M/yyyy"): (1, 0, 0, False), ("c", "M/d/yyyy"): (1, 0, 0, False), ("c", "yyyy-MM-dd"): (1, 0, 0, False)}
    assert cleaning.chosen_formats(tally) == {"a": "d/M/yyyy", "b": "yyyy-MM-dd"}
    empty = cleaning.date_format_tally(df.where(F.lit(False)), ["a"], formats)
    assert sorted(rows(empty, "n_values", "n_parsed", "n_only", "chosen")) == [(0, 0, 0, False)] * 3
