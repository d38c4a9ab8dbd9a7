"""The test tables read as event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trendcast.functions.periods import with_period
from trendcast.operators.splits import Window
from trendcast.sources.tables import read_events

PRIORITY_FLAGS = {
    "kw_urgent": "1-URGENT", "kw_high": "2-HIGH", "kw_medium": "3-MEDIUM",
    "kw_unspecified": "4-NOT SPECIFIED", "kw_low": "5-LOW",
}
STATUS_FLAGS = {"is_filled": "F", "is_open": "O", "is_partial": "P"}
FLAGS, TYPES = tuple(PRIORITY_FLAGS), tuple(STATUS_FLAGS)
STOP_WORDS = ("the", "of", "and", "in", "on", "la", "le", "der", "die", "el")


def month(year: int, number: int) -> int:
    return year * 12 + number - 1


# The orders table spans 1995-01 to 2001-08.
WINDOWS = (
    Window(month(1998, 12), month(1999, 1), month(1999, 6)),
    Window(month(1999, 6), month(1999, 7), month(1999, 12)),
    Window(month(1999, 12), month(2000, 1), month(2000, 6)),
)
TRAIN_END, VAL_END, HORIZON = month(1999, 12), month(2000, 6), 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_events(spark, f"{sf_dir}/{name}.parquet")


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month with one 0/1 flag per priority and per status."""
    orders = with_period(table(spark, sf_dir, "orders"), "o_orderdate", "month")
    flags = {n: (F.col("o_orderpriority") == v).cast("int") for n, v in PRIORITY_FLAGS.items()}
    flags |= {n: (F.col("o_orderstatus") == v).cast("int") for n, v in STATUS_FLAGS.items()}
    return orders.withColumns(flags)


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_period(table(spark, sf_dir, "events"), "ts", "hour")


def nation_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month with the customer's nation: one series per nation."""
    orders = with_period(table(spark, sf_dir, "orders"), "o_orderdate", "month").select("o_custkey", "period")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    return orders.join(customers, "o_custkey")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as untidy text: padded names, shared ids, unreadable dates, years and flags."""
    k = F.col("o_orderkey")
    year = F.year("o_orderdate").cast("string")
    flag = k % 7
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("k"), F.floor(k / 2).cast("string")).alias(" Order_ID "),
        F.when(k % 11 == 0, "not a date").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("Order_Date"),
        F.when(k % 17 == 0, "n/a").when(k % 13 == 0, F.concat(year, F.lit(".7")))
        .when(k % 29 == 0, "1969").when(k % 31 == 0, "2099").otherwise(year).alias(" YEAR"),
        F.when(flag == 0, "0.5").when(flag == 1, "2").when(flag == 2, "-1").when(flag == 3, "NaN")
        .when(flag == 4, "0.7").when(flag == 5, "1").alias("KW_Rush"),
        k.alias("Seq"),
    )


def document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels and simple measures of the text."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", "text", "lang", "source", "quality", "toxic",
        F.col("n_chars").cast("double").alias("len_chars"),
        F.size(F.split("text", " ")).cast("double").alias("len_words"),
        F.col("text").rlike("[0-9]").cast("int").alias("kw_number"),
        F.col("text").rlike("[A-Z]{2}").cast("int").alias("kw_acronym"),
        F.contains("text", F.lit("@")).cast("int").alias("kw_address"),
        (F.col("lang") == "en").cast("int").alias("is_english"),
        (F.col("lang") != "en").cast("int").alias("is_other_lang"),
    )
