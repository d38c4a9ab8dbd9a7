"""Readers and writers: event tables, report tables, stage hand-off."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

def read_events(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
    row_order: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Scan an event table from CSV (with header) or Parquet.

    Without a schema, CSV columns arrive as text: no extra pass over the file is
    spent on guessing types, and the cleaning step coerces what it needs by
    name. With ``schema``, columns are taken by name, in any order of the
    header, and cast; a column that the header lacks is an error. Quoted values
    may hold line breaks with ``multi_line``, at the price of one task a file.
    ``row_order`` adds ``file_path`` and ``file_row``, which sort like the rows
    of the files; cleaning uses them to keep the first of several duplicates.
    """
    fmt = fmt or ("csv" if path.rstrip("/").endswith((".csv", ".csv.gz")) else "parquet")
    if fmt == "csv":
        df = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}; use csv or parquet")
    if row_order:
        # Row ids grow with the position inside a scan task, and the block start
        # orders the tasks of one file.
        row = F.col("_metadata.row_index") if fmt == "parquet" else F.monotonically_increasing_id()
        df = df.withColumns({
            "file_path": F.col("_metadata.file_path"),
            "file_row": F.struct(F.col("_metadata.file_block_start").alias("block"), row.alias("row")),
        })
    if schema is not None:
        wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        kept = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted.fields]
        df = df.select(*kept, *(["file_path", "file_row"] if row_order else []))
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> None:
    """Overwrite ``path``. ``single_file`` is for report tables only."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}; use csv or parquet")


def write_events(df: DataFrame, path: str, partition_by: str = "year") -> None:
    """Persist the clean event table, one folder per period.

    The rebalance hint groups rows by period for few files per folder, and lets
    adaptive execution split a period that holds a large part of all rows.
    """
    df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)


def parse_parameters(col: Column) -> Column:
    """JSON text to a name → number map; unreadable or missing text gives an empty map."""
    empty = F.create_map().cast("map<string,double>")
    return F.coalesce(F.from_json(col, "map<string,double>", {"mode": "PERMISSIVE"}), empty)


def read_hyperparameters(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    model_col: str = "model",
    json_col: str = "selected_hyperparameters",
    names: Sequence[str] = (),
) -> dict[str, dict[str, float]]:
    """Selected parameters per model name; a missing table gives an empty dict.

    One row per model name, so the result is as small as the model registry.
    """
    if not _exists(spark, path):
        return {}
    df = spark.read.option("header", True).option("escape", '"').csv(path) if fmt == "csv" else spark.read.parquet(path)
    if names:
        df = df.filter(F.col(model_col).isin(list(names)))
    rows = df.select(F.col(model_col), parse_parameters(F.col(json_col))).collect()
    return {name: dict(params) for name, params in rows}


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)
