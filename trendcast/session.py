"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(app_name: str = "trendcast", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the shared folder that the cluster names in ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(shared)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. A session on one machine without that setting uses its warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and spark.sparkContext.master.startswith("local"):
        named = spark.conf.get("spark.sql.warehouse.dir")
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return named.rstrip("/")


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Within it rows go to Python about ``size`` bytes at a time; the session's own setting is put back.

    A batch of large rows is held several times over: in Arrow's buffers, in the stream's and by Python.
    """
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_BYTES)
        else:
            spark.conf.set(BATCH_BYTES, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back, dropping its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
