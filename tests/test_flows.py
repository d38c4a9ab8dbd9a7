import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.fixtures import rows
from trendcast import session
from trendcast.operators import models, splits
from trendcast.plans import flows
from trendcast.sources import read_events, read_hyperparameters, write_table


def raw_events(spark):
    """Forty years of events with two topics, written as a text file would hold them."""
    ids = spark.range(4000)
    year = 1981 + F.floor(F.col("id") / 100)
    topic = F.pmod(F.hash("id"), F.lit(3))
    return ids.select(
        F.concat(F.lit("p"), "id").alias(" Event_ID "), year.cast("string").alias("YEAR"),
        F.when(topic == 0, "radio antenna array").when(topic == 1, "cloud data service").otherwise("secure key store").alias("Title"),
        (topic == 0).cast("int").cast("string").alias("KW_Radio"), (topic == 1).cast("int").cast("string").alias("KW_Cloud"),
        F.lit("1").alias("is_main"), F.when(topic == 2, "b").otherwise("a").alias("kind"), F.lit(3).alias("words"))


SPEC = flows.EventSpec(
    id_col="event_id", flags=("kw_radio", "kw_cloud"), types=("is_main",), measures=("words",), segments=("kind",),
    numbers=("kw_radio", "kw_cloud", "words"), text="title")
PLAN = flows.ForecastPlan(
    windows=(splits.Window(2000, 2001, 2005), splits.Window(2005, 2006, 2010)), horizon=3,
    model_names=(models.NAIVE, models.LINEAR, models.FOREST), grids={models.FOREST: [{"n_estimators": 3, "max_depth": 2}]},
    k_values=(2, 3), restarts=1, text_grid=({"min_df": 2, "max_features": 30, "svd_components": 3},))


@pytest.fixture(scope="module")
def out(tmp_path_factory):
    return str(tmp_path_factory.mktemp("flow"))


def test_three_flows_hand_over_through_files(spark, out):
    profile = flows.run_profile(raw_events(spark), SPEC, out)
    assert profile["period_summary"].first()["n_rows"] == 4000
    assert profile["period_counts"].count() == 40 and profile["kind_shares"].count() == 80
    scan = profile["clean_events"].filter("year = 1999").select("kw_radio")
    assert "PartitionFilters: [isnotnull(year" in scan._jdf.queryExecution().executedPlan().toString()

    forecast = flows.run_forecast(spark, SPEC, PLAN, out)
    assert forecast["future"].count() == 9 and forecast["selected_future"].count() == 3
    assert forecast["rolling_detailed"].count() == 6 and forecast["ablation"].count() == 8
    assert forecast["recommendation"].count() == 2 and forecast["model_metrics"].count() == 6
    assert {"interpretation_linear_regression", "interpretation_random_forest", "tuning_random_forest"} <= set(forecast)

    result = flows.run_segments(spark, SPEC, PLAN, out)
    assert sum(n for (n,) in rows(result["cluster_balance"], "n")) == 8000
    assert set(rows(result["baseline_vs_segmented"].select("scheme").distinct(), "scheme")) == {
        ("no_segmentation",), ("text_kmeans",), ("numeric_kmeans",)}
    assert result["future_comparison"].count() == 3 * 3 * 2
    assert result["limitations"].count() == 5


def test_missing_path_is_an_error_and_missing_parameters_are_not(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_events(spark, str(tmp_path / "none.parquet"))
    assert read_hyperparameters(spark, str(tmp_path / "none")) == {}


def test_unreadable_parameters_become_empty(spark, tmp_path):
    path = str(tmp_path / "params")
    data = [("a", '{"x": 1}'), ("b", "oops"), ("c", None), ("d", "{'y': 0.5}")]
    write_table(spark.createDataFrame(data, "model string, selected_hyperparameters string"), path)
    assert read_hyperparameters(spark, path) == {"a": {"x": 1.0}, "b": {}, "c": {}, "d": {"y": 0.5}}
    assert read_hyperparameters(spark, path, names=["a"]) == {"a": {"x": 1.0}}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_file_order_decides_which_duplicate_stays(spark, tmp_path, fmt):
    from trendcast.operators.cleaning import keep_first

    path = str(tmp_path / f"events_{fmt}")
    data = [(f"k{i % 50}", str(i)) for i in range(1000)]
    write_table(spark.createDataFrame(data, "id string, v string").coalesce(1), path, fmt)
    df = read_events(spark, path, fmt, row_order=True)
    kept = keep_first(df, "id", ["file_path", "file_row"])
    assert sorted(int(v) for (v,) in rows(kept, "v")) == list(range(50))
    with pytest.raises(ValueError, match="unsupported"):
        read_events(spark, path, "xml")


def test_csv_round_trip_with_a_declared_schema(spark, tmp_path):
    path = str(tmp_path / "typed.csv")
    write_table(spark.createDataFrame([(2001, 'a "b", c', 0.5)], "year int, name string, score double"), path, "csv", single_file=True)
    back = read_events(spark, path, schema="name string, score double, year int")  # not in the header's order
    assert back.schema.simpleString() == "struct<name:string,score:double,year:int>"
    assert tuple(back.first()) == ('a "b", c', 0.5, 2001)
    with pytest.raises(Exception, match="missing"):
        read_events(spark, path, schema="missing string").collect()


def test_csv_with_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "lines.csv").write_text('title,year\n"a\nb",2001\nc,2002\n')
    back = read_events(spark, str(tmp_path / "lines.csv"), multi_line=True)
    assert sorted(rows(back, "title", "year")) == [("a\nb", "2001"), ("c", "2002")]


def test_checkpoint_folder_comes_from_the_session(spark, tmp_path):
    session.ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir()
    df = session.cut_lineage(spark.range(5))
    assert df.count() == 5
