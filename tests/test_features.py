import pytest
from pyspark.sql import functions as F

from tests.fixtures import YEARS, flag_events, rows, totals
from trendcast.operators import features, splits


def test_modelling_table_by_hand(spark):
    t = features.modelling_table(flag_events(spark), ["kw_a", "kw_b"], period="year").orderBy("year")
    assert t.columns == [
        "year", "n", "kw_a", "kw_b", "kw_a_share", "kw_b_share", "trend", "lag_1", "lag_2", "growth_rate",
        "growth_rate_lag_1", "kw_a_share_lag_1", "kw_b_share_lag_1"]
    assert rows(t, *t.columns) == [
        (2000, 2, 1, 1, 0.5, 0.5, 1, None, None, None, None, None, None),
        (2001, 3, 2, 2, 2 / 3, 2 / 3, 2, 2, None, 0.5, None, 0.5, 0.5),
        (2002, 1, 0, 1, 0.0, 1.0, 3, 3, 2, -2 / 3, 0.5, 2 / 3, 2 / 3)]


def test_trend_counts_present_periods_unless_dense(spark):
    df = spark.createDataFrame([(2000, 1), (2003, 0)], "period int, kw_a int")
    assert rows(features.modelling_table(df, ["kw_a"]).orderBy("period"), "period", "trend") == [(2000, 1), (2003, 2)]
    dense = features.modelling_table(df, ["kw_a"], densify=True).orderBy("period")
    assert rows(dense, "period", "n", "trend", "kw_a", "kw_a_share") == [
        (2000, 1, 1, 1, 1.0), (2001, 0, 2, 0, None), (2002, 0, 3, 0, None), (2003, 1, 4, 0, 0.0)]


def test_segment_growth_is_zero_where_undefined(spark):
    df = spark.createDataFrame([(2000, 0), (2000, 0), (2001, 1), (2003, 0)], "period int, cluster int")
    t = features.segment_modelling_table(features.segment_counts(df, "cluster"), ["cluster"])
    zero = t.filter("cluster = 0").orderBy("period")
    assert rows(zero, "n", "growth_rate", "growth_rate_lag_1") == [(2, 0.0, None), (0, -1.0, 0.0), (0, 0.0, -1.0), (1, 0.0, 0.0)]


def test_growth_against_known_values(spark):
    g = rows(features.growth_rate(totals(spark), (), "year").orderBy("year"), "growth_rate")
    assert g[0] == (None,)
    assert g[1][0] == pytest.approx(0.16666666666666674) and g[2][0] == pytest.approx(0.0714285714285714)


def test_default_features_are_safe_and_ordered(spark):
    t = features.modelling_table(flag_events(spark), ["kw_a", "kw_b"], period="year")
    names = features.default_features(t.columns, ["kw_a", "kw_x", "kw_b"])
    assert names == ["trend", "lag_1", "lag_2", "growth_rate_lag_1", "kw_a_share_lag_1", "kw_b_share_lag_1"]
    audit = features.leakage_audit(t, [*names, "kw_a_share"])
    safe = dict(rows(audit, "feature", "is_leakage_safe"))
    assert all(safe[n] for n in names) and not safe["kw_a_share"]
    assert dict(rows(audit, "feature", "n_known"))["lag_2"] == 1


def test_ablation_sets_grow():
    sets = features.ablation_sets(["trend", "lag_1", "lag_2", "growth_rate_lag_1", "kw_a_share_lag_1"], ["kw_a"])
    assert [len(s["features"]) for s in sets] == [1, 3, 4, 5]


def test_model_rows_drop_gaps(spark):
    t = features.lag_table(totals(spark), (), "year")
    assert features.model_rows(t, ["trend"], "n", (), "year").count() == 50
    assert features.model_rows(t, list(features.SEGMENT_FEATURES), "n", (), "year").count() == 48


def test_last_values_carry_the_last_known_share(spark):
    df = spark.createDataFrame([(1, 5, 0.1), (2, 6, 0.2), (3, 7, None)], "period int, n long, s_share double")
    row = features.last_values(features.lag_table(df), carry=["s_share"]).first()
    assert (row["last_period"], row["last_trend"], row["last_value"], row["previous_value"], row["s_share"]) == (3, 3, 7.0, 6.0, 0.2)


def test_split_is_disjoint_and_a_gap_drops_rows(spark):
    t = totals(spark)
    by = dict(rows(splits.chrono_split(t, 2010, 2016, period="year").groupBy("split").count(), "split", "count"))
    assert by == {"train": 35, "validation": 6, "test": 9} and sum(by.values()) == len(YEARS)
    gap = splits.chrono_split(t, 2010, 2016, 2013, "year")
    assert gap.filter(F.col("year").between(2011, 2012)).count() == 0


def test_window_rows_have_one_role_each(spark):
    w = [splits.Window(2000, 2001, 2005), splits.Window(2005, 2007, 2010)]
    out = splits.window_rows(totals(spark), w, "year")
    counts = {(r[0], r[1]): r[2] for r in rows(out.groupBy("window_id", "role").count(), "window_id", "role", "count")}
    assert counts == {(1, "train"): 25, (1, "validation"): 5, (2, "train"): 30, (2, "validation"): 4}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_grid():
    grid = splits.parameter_grid({"b": [1, 2], "a": [0.5]})
    assert grid == [{"b": 1, "a": 0.5}, {"b": 2, "a": 0.5}]
