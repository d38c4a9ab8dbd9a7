"""Token counts of every prefix, and what they answer without encoding again."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trendcast.llm.shared import small_batches, text_or_empty, tidy
from trendcast.llm.vocabulary import PrefixCounter, tokenizer_path

SCHEMA = "n_bytes long, n_tokens long, prefix_changes binary"


def prefix_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, prefix_changes) of every whole text; a null text counts as empty.

    ``prefix_changes`` holds, after each character, the change of the exact token count as a 16-bit number: its
    running sum is the count of that prefix. One row per document, in place, without a shuffle.
    """
    path = path or tokenizer_path("byte_bpe_50k.json")
    kept = docs.select("doc_id", text_or_empty(docs).alias("text"))
    small_batches(docs.sparkSession)
    id_type = kept.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(path)
        for batch in batches:
            changes, n_bytes, n_tokens = [], [], []
            for value in batch.column(1):
                text = value.as_py()
                found = counter.changes(text)
                changes.append(found)
                n_bytes.append(len(text.encode()))
                n_tokens.append(int(np.frombuffer(found, np.int16).sum(dtype=np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array(changes, pa.binary())], ["doc_id", "n_bytes", "n_tokens", "prefix_changes"])

    return kept.mapInArrow(tidy(count), f"doc_id {id_type}, {SCHEMA}")


def _running(changes) -> list[int]:
    out, count = [0], 0
    for c in array("h", bytes(changes)):
        count += c
        out.append(count)
    return out


def tokens_of_prefix(changes: Column, characters: Column) -> Column:
    """Tokens of the first ``characters`` characters (all, if the text is shorter)."""

    @F.pandas_udf("long")
    def of(c, n):
        import pandas as pd

        return pd.Series([sum(array("h", bytes(x)[: 2 * max(0, int(k))])) for x, k in zip(c, n)], dtype="int64")

    return of(changes, characters)


def longest_prefix(changes: Column, budget: Column) -> Column:
    """Characters of the longest prefix that has at most ``budget`` tokens; 0 for a budget below 1."""

    @F.pandas_udf("long")
    def of(c, b):
        import pandas as pd

        return pd.Series([max((i for i, n in enumerate(_running(x)) if n <= k), default=0) for x, k in zip(c, b)],
                         dtype="int64")

    return of(changes, budget)
