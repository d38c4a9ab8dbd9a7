import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tests.fixtures import flag_events, rows
from trendcast.functions import first_arg_max, period_index
from trendcast.operators import reshape, rollups, stats


def test_counts_add_up_and_shares_are_fractions(spark):
    events = flag_events(spark)
    table = rollups.period_rollup(events, period="year", flags=["kw_a", "kw_b", "kw_none"]).orderBy("year")
    assert sum(r["n"] for r in table.collect()) == events.count()
    assert rows(table, "kw_a_share", "kw_b_share") == [(0.5, 0.5), (2 / 3, 2 / 3), (0.0, 1.0)]


def test_selecting_counts_reads_only_the_period(spark, tmp_path):
    flag_events(spark).write.parquet(str(tmp_path / "e"))
    events = spark.read.parquet(str(tmp_path / "e"))
    plan = rollups.period_rollup(events, period="year", flags=["kw_a"]).select("year", "n")
    assert "kw_a" not in plan._jdf.queryExecution().executedPlan().toString()


def test_type_shares_divide_by_the_flag_total(spark):
    df = spark.createDataFrame([(2000, 1, 0), (2000, 0, 0), (2000, 0, 1), (2001, 0, 0)], "year int, is_x int, is_y int")
    out = rollups.type_shares(df, ["is_x", "is_y"], period="year").orderBy("year")
    assert rows(out, "is_x_share") == [(0.5,), (None,)]


def test_measures_that_do_not_exist_give_an_empty_table(spark):
    assert rollups.measure_means(flag_events(spark), ["absent"], period="year").count() == 0


def test_top_n_ties_go_to_the_smaller_value_and_null_is_missing(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "c"), (2, "c"), (2, None)], "period int, s string")
    out = rollups.segment_trends(df, "s", top_n=2)
    assert sorted(rows(out, "period", "s", "n")) == [(1, "a", 1), (1, "c", 1), (1, "other", 1), (2, "c", 1), (2, "other", 1)]
    full = rollups.segment_trends(df, "s")
    assert (2, "missing", 1) in rows(full, "period", "s", "n")


def test_shares_wide_and_long_agree(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(1, "b")] + [(2, "b")], "period int, s string")
    trends = rollups.segment_trends(df, "s")
    shares = rollups.segment_shares(trends, "s")
    assert sorted(rows(shares, "period", "s", "share")) == [(1, "a", 0.75), (1, "b", 0.25), (2, "b", 1.0)]
    wide = reshape.to_wide(trends, ["period"], "s", "n", ["a", "b"]).orderBy("period")
    assert rows(wide, "a", "b") == [(3, 1), (0, 1)]
    assert sorted(rows(reshape.to_long(wide, ["period"]), "period", "name", "value")) == [
        (1, "a", 3), (1, "b", 1), (2, "a", 0), (2, "b", 1)]


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "period int, x int")
    assert tuple(rollups.period_summary(empty).first()) == (0, 2, None, None, 0, 0.0, 0, 0)


def test_densify_fills_gaps_margins_and_honours_bounds(spark):
    df = spark.createDataFrame([(0, 2000, 2), (1, 2001, 1), (0, 2003, 1)], "k int, period int, n long")
    out = reshape.densify(df, ["k"]).orderBy("k", "period")
    assert rows(out, "n") == [(2,), (0,), (0,), (1,), (0,), (1,), (0,), (0,)]
    narrow = reshape.densify(df, ["k"], start=2002, end=2004).orderBy("k", "period")
    assert rows(narrow, "k", "period", "n") == [
        (0, 2002, 0), (0, 2003, 1), (0, 2004, 0), (1, 2002, 0), (1, 2003, 0), (1, 2004, 0)]
    before = reshape.densify(df, ["k"], start=1990, end=1991).orderBy("k", "period")
    assert rows(before, "n") == [(0,)] * 4


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.tuples(st.integers(0, 3), st.integers(0, 12)), st.integers(1, 9), min_size=1, max_size=12),
       st.integers(0, 12), st.integers(0, 12))
def test_densify_matches_a_spine(spark, cells, a, b):
    lo, hi = min(a, b), max(a, b)
    df = spark.createDataFrame([(k, p, n) for (k, p), n in cells.items()], "k int, period int, n int")
    want = [(k, p, cells.get((k, p), 0)) for k in sorted({k for k, _ in cells}) for p in range(lo, hi + 1)]
    assert sorted(rows(reshape.densify(df, ["k"], start=lo, end=hi), "k", "period", "n")) == want


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1, 1, 0), (0, 1, 1), (1, 1, 0)], "a int, b int, c int")
    r = {(x, y): v for x, y, v in rows(stats.flag_correlation(df, ["a", "b", "c", "none"]), "feature_a", "feature_b", "r")}
    assert len(r) == 9 and r["a", "b"] is None and r["b", "b"] is None
    assert r["a", "c"] == pytest.approx(-1.0) and r["c", "a"] == pytest.approx(-1.0)


def test_evidence_uses_complete_pairs(spark):
    df = spark.createDataFrame([(1, 1.0, 3.0), (2, None, 3.0), (3, 3.0, 3.0), (5, 4.0, 3.0)], "n int, kw_x_share double, title_c double")
    out = stats.feature_evidence(df, ["kw_x_share", "title_c", "gone"])
    first, last = out.collect()
    assert (first["feature"], first["feature_group"], first["missing_count"]) == ("kw_x_share", "keyword_share", 1)
    assert first["correlation_with_target"] == pytest.approx(0.9820, abs=1e-4)
    assert last["correlation_with_target"] is None and last["std"] == 0.0 and last["feature_group"] == "title_feature"
    assert stats.top_evidence(out, 1).count() == 1


def test_first_name_wins_a_tie(spark):
    df = spark.createDataFrame([(0.2, 0.5, 0.5), (None, None, None)], "a double, b double, c double")
    out = df.select(first_arg_max({c: F.col(c) for c in "abc"}).alias("best"))
    assert rows(out, "best") == [("b",), (None,)]


@pytest.mark.parametrize("grain, number", [
    ("year", 2024), ("quarter", 2024 * 4 + 1), ("month", 2024 * 12 + 4), ("day", 19844), ("hour", 19844 * 24 + 7)])
def test_periods(spark, grain, number):
    df = spark.sql("SELECT timestamp_ntz'2024-05-01 07:30:00' AS a, timestamp'2024-05-01 07:30:00' AS b")
    for c in "ab":
        p = period_index(F.col(c), grain)
        assert rows(df.select(p.alias("p")), "p") == [(number,)]


def test_unknown_grain_is_an_error():
    with pytest.raises(ValueError, match="grain"):
        period_index(None, "decade")
