"""What the operators share: tables in the shared folder, row keys and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Words end at ASCII white space only.
WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_BYTES = 12 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names for checkpoints. A session on one machine without that setting uses its
    warehouse; on a cluster that is refused."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and spark.sparkContext.master.startswith("local"):
        named = spark.conf.get("spark.sql.warehouse.dir")
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return named.rstrip("/") + "/llm"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: its lineage ends there, and a lost executor
    loses nothing of it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with _shuffles_removed(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


@contextlib.contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of what is run here as it ends, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def emptied(*tables: DataFrame) -> None:
    """Free the disk of tables from ``written`` that nothing reads any more."""
    for table in tables:
        none = [F.lit(None).cast(field.dataType).alias(field.name) for field in table.schema]
        table.sparkSession.range(0).select(*none).write.mode("overwrite").parquet(table.written_to)


def text_or_empty(df: DataFrame, text: str = "text") -> Column:
    return F.coalesce(df[text], F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one, named row, so that none of them meets a name of ours; ``row.*`` gives them back."""
    return F.struct(*(df[f"`{c.replace('`', '``')}`"] for c in df.columns)).alias("row")


def small(table: DataFrame) -> DataFrame:
    """A table of few columns, marked for broadcast if the bytes of its values are at most ``BROADCAST_BYTES``."""
    size = F.lit(0).cast("long")
    for name, kind in table.dtypes:
        width = F.octet_length(name) if kind in ("string", "binary") else 8 * F.size(name) if kind.startswith("array") else F.lit(0)
        size = size + F.coalesce(width, F.lit(0)) + 8
    bytes_ = table.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(table) if bytes_ <= BROADCAST_BYTES else table


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Send texts to Python at most ``rows`` at a time, so that memory follows the length of texts and not their number."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= rows:
        spark.conf.set(name, rows)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` that gives its memory back when a task ends: Python workers live on and take tasks of later stages."""
    def run(batches):
        try:
            yield from work(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim:
                trim(0)

    return run


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): its root is the smallest node that it can reach.

    Alternates the large-star and small-star steps until nothing changes, a number of rounds that grows with the
    logarithm of the longest chain. Each round is written to the shared folder. Smallest neighbours are found by
    partial aggregates, and the joins may be split, so a node with very many edges is no bottleneck.
    """
    def summed(df):
        row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 31)).alias("h")).first()
        return row["n"], row["h"]

    now = written(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                  name)
    state = summed(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(nearest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(nearest.withColumnRenamed("m", "v")).distinct(), name)
        before, state = state, summed(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
