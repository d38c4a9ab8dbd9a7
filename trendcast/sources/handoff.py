"""Versioned hand-off of event tables between stages.

A version is a folder of Parquet files, one subfolder a period. Its manifest, rows per period, is written after the
data and by one small file, so a version whose write broke off is never read, and a new version never disturbs a
reader of the one before.

    <path>/data/<version>/<period>=.../*.parquet
    <path>/manifest/<version>.parquet
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from trendcast.sources.tables import _exists


def publish(df: DataFrame, path: str, period: str = "period") -> str:
    """Write ``df`` as a new version and return its name. Rows without a period are kept, in a folder of their own.

    The rebalance hint groups rows by period for few files, and lets adaptive execution split a period that holds a
    large part of all rows. The counts of the manifest are taken from what was written, from file footers.
    """
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/data/{version}"
    df.hint("rebalance", period).write.partitionBy(period).parquet(folder)
    stored = df.sparkSession.read.schema(df.schema).parquet(folder)
    counts = stored.groupBy(F.col(period).alias("period")).agg(F.count(F.lit(1)).alias("n"))
    # The schema travels with the manifest: folder names alone do not tell the type of a period.
    (counts.withColumns({"version": F.lit(version), "period_column": F.lit(period), "schema": F.lit(df.schema.json())})
     .coalesce(1).write.parquet(f"{path}/manifest/{version}.parquet"))
    return version


def manifest(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """Rows (period, n) of a version, the newest by default.

    A table without rows has a manifest without rows, which names no version; it counts as not published.
    """
    if not _exists(spark, f"{path}/manifest"):
        raise ValueError(f"nothing is published at {path}")
    rows = spark.read.parquet(f"{path}/manifest/*.parquet")
    if version is None:
        version = rows.agg(F.max("version")).first()[0]
    found = rows.where(F.col("version") == version)
    if version is None or found.isEmpty():
        raise ValueError(f"no such version at {path}: {version}")
    return found


def read_version(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The rows of a version, the newest by default. A filter on the period reads its folders only."""
    head = manifest(spark, path, version).select("version", "schema").first()
    schema = T.StructType.fromJson(json.loads(head["schema"]))
    return spark.read.schema(schema).parquet(f"{path}/data/{head['version']}").select(*[f"`{n}`" for n in schema.names])


def damaged_periods(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """Periods whose rows are not as many as the manifest says: (period, n, found). None in a sound version."""
    wanted = manifest(spark, path, version)
    head = wanted.select("version", "period_column").first()
    rows = read_version(spark, path, head["version"])
    found = rows.groupBy(F.col(f"`{head['period_column']}`").alias("p")).agg(F.count(F.lit(1)).alias("found"))
    both = wanted.select("period", "n").join(found, F.col("period").eqNullSafe(F.col("p")), "full_outer")
    return both.select(F.coalesce("period", "p").alias("period"), F.coalesce("n", F.lit(0)).alias("n"),
                       F.coalesce("found", F.lit(0)).alias("found")).where("n != found")
