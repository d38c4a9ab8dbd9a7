"""A training corpus from raw documents: each stage is one operator, written as Parquet and read again for the next.

Documents that are toxic go; lines that repeat an earlier line go, and with them documents of which nothing is left;
of near duplicates one document stays; the rest is mixed to the target weights of its sources, in shuffled shards;
and the mixture is packed into sequences. Every stage works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trendcast.llm import lines, mixing, packing, simhash, toxicity
from trendcast.llm.shared import small, whole_row, written

TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below ``TOXIC_FROM``. The model learns from the labelled rows of ``docs``."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scores(docs, model).where(F.col("score") < TOXIC_FROM).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; ``n_chars`` follows. Those whose lines with words all went, go too."""
    out = lines.dedup_lines(docs)
    emptied = (F.col("n_removed") > 0) & (F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")) == "")
    out = out.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(
            F.col("n_chars")))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: of those with the id that names the group, one of the smallest
    fingerprint. An id that rows repeat may stay once for each group that it names."""
    found = simhash.grouped(docs)
    named = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = written(named.groupBy("root").agg(F.min("fp").alias("kept_fp"), F.min("doc_id").alias("id")), "kept-documents")
    repeated = written(found.groupBy(F.col("doc_id").alias("id")).count().where("count > 1").select("id"), "repeated-ids")

    def among(some, ids, how):
        return some.alias("x").join(small(ids).alias("y"), F.col("x.id").eqNullSafe(F.col("y.id")), how)

    out = among(docs.select(F.col("doc_id").alias("id"), whole_row(docs)), kept.select("id").distinct(), "left_semi")
    if repeated.isEmpty():
        return out.select("row.*")
    # Rows that share an id are told apart by fingerprint and, where that is equal too, by a row number.
    once = among(out, repeated, "left_anti")
    several = written(among(out, repeated, "left_semi").withColumn("no", F.monotonically_increasing_id()), "repeated-rows")
    fps = simhash.fingerprints(several.select(F.col("no").alias("doc_id"), F.col("row.text").alias("text")))
    rows = several.select("no", F.col("id").alias("row_id")).join(fps.withColumnRenamed("doc_id", "no"), "no")
    chosen = rows.join(kept, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("fp") == F.col("kept_fp"))).groupBy("root").agg(
        F.min("no").alias("no")).select("no")
    return once.select("row.*").unionByName(several.join(chosen, "no", "left_semi").select("row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture in shard order; a document that is drawn twice stands there twice."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 4096 tokens."""
    pieces = packing.token_pieces(docs).select(
        "doc_id", "piece", "start", F.floor(F.octet_length("ids") / 4).alias("length"),
        F.crc32("ids").alias("ids_crc32"))
    return packing.packed_pieces(pieces)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

# The scores and fingerprints of the first and third stage are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
