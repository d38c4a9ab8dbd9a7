"""Conversations in order, as segments that each fit a task.

The rows are range-partitioned by conversation, turn and what breaks ties, and sorted, so a conversation of any length
spreads over as many tasks as its rows need. A task cuts what it holds into segments: runs of rows of one conversation,
of bounded length. Nearly every conversation is one segment.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trendcast.llm.shared import parallelism, small_batches

SEGMENT_ROWS = 4096
SEGMENT_CHARS = 8_000_000


def turns(conversations: DataFrame, instead: str) -> DataFrame:
    """(conv_id, turn, role, text), whatever else the table holds; a null role or text reads as ``instead``."""
    return conversations.select(
        conversations["conv_id"].alias("conv_id"), conversations["turn"].cast("long").alias("turn"),
        F.coalesce(conversations["role"], F.lit(instead)).alias("role"),
        F.coalesce(conversations["text"], F.lit(instead)).alias("text"))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def runs(batches: Iterator[pa.RecordBatch], most_rows: int, most_chars: int) -> Iterator[tuple[object, int, list[tuple]]]:
    """(conv_id, place of the first row, rows) of each segment; a row is what follows conv_id and place, text last."""
    now, at, rows, chars = None, None, [], 0
    for batch in batches:
        for conv_id, place, *row in zip(*(column.to_pylist() for column in batch.columns)):
            n = len(row[-1] or "")
            if at is None or conv_id != now or len(rows) >= most_rows or chars + n > most_chars:
                if at is not None:
                    yield now, at, rows
                now, at, rows, chars = conv_id, place, [], 0
            rows.append(tuple(row))
            chars += n
    if at is not None:
        yield now, at, rows


def segments(rows: DataFrame, make: Callable[[object, int, list[tuple]], tuple], schema: str,
             most_rows: int = SEGMENT_ROWS, most_chars: int = SEGMENT_CHARS) -> DataFrame:
    """``make`` of every segment of ``rows`` (conv_id, turn, role, ..., text): conv_id, ``at`` and ``schema``.

    Rows go by turn, nulls first; ties by role, the first 64 characters of the text and its digest. ``at`` grows along
    a conversation, also from one partition to the next. Equal rows may be dealt to several tasks.
    """
    id_type = rows.schema["conv_id"].dataType.simpleString()
    small_batches(rows.sparkSession, 2000)
    keys = [F.col("conv_id"), F.col("turn"), F.col("role"), F.substring("text", 1, 64), F.md5(F.col("text").cast("binary"))]
    first, *others = rows.columns
    sorted_rows = rows.withColumn("__dealt", F.pmod(F.monotonically_increasing_id(), F.lit(1024))).repartitionByRange(
        parallelism(rows.sparkSession), *keys, "__dealt").sortWithinPartitions(*keys)
    sorted_rows = sorted_rows.select(first, F.monotonically_increasing_id().alias("at"), *others)
    names = [first, "at", *[part.split()[0] for part in _fields(schema)]]
    full = f"conv_id {id_type}, at long, {schema}"

    def cut(batches):
        block = []
        size = 0
        for conv_id, at, own in runs(batches, most_rows, most_chars):
            block.append((conv_id, at, *make(conv_id, at, own)))
            size += sum(len(r[-1] or "") for r in own) + 200
            if size > 4_000_000:
                yield as_batch(block, names, types)
                block, size = [], 0
        if block:
            yield as_batch(block, names, types)

    types = _arrow_types(rows.sparkSession, full)
    return sorted_rows.mapInArrow(cut, full)


def _fields(schema: str) -> list[str]:
    """The top-level fields of a schema string."""
    out, depth = [""], 0
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [part.strip() for part in out]


def _arrow_types(spark, schema: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return list(to_arrow_schema(_parse_datatype_string(schema)).types)


def as_batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def streamed(df: DataFrame, fold: Callable, schema: str) -> DataFrame:
    """One row for each conversation of ``df`` (conv_id, at, ...): ``fold`` of its rows in order, read as a stream.

    ``fold`` takes an iterator of rows (what follows conv_id and at) and returns a tuple. Only what it keeps stays in
    memory, so a conversation's texts may be of any size.
    """
    from itertools import groupby

    id_type = df.schema["conv_id"].dataType.simpleString()
    small_batches(df.sparkSession, 2000)
    full = f"conv_id {id_type}, {schema}"
    types = _arrow_types(df.sparkSession, full)
    names = ["conv_id", *[part.split()[0] for part in _fields(schema)]]

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(column.to_pylist() for column in batch.columns))

        for conv_id, own in groupby(rows(), key=lambda r: (r[0],)):
            yield as_batch([(conv_id[0], *fold(r[2:] for r in own))], names, types)

    return df.repartition(parallelism(df.sparkSession), "conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(run, full)
