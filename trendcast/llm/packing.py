"""Best-fit packing of token sequences by hierarchical residual packing.

Every partition packs its own items by best fit, largest first. Bins that are nearly full leave. The others are
items of the next round, as wholes, on an eighth of the partitions; the last round lets all bins leave. What travels
is a bin's size with the numbers of its items, and after the first round only for the few bins that are not full.
A partition is packed in runs of bounded length, each handing its open bins to the next, so memory does not depend on
the size of a partition; rounds stop narrowing where a task would get more than ``task_items`` bins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trendcast.llm.shared import small_batches, text_or_empty, tidy, written
from trendcast.llm.vocabulary import WordEncoder, tokenizer_path

CAPACITY = 4096
BIN = "full boolean, size long, items array<long>, offsets array<long>"


def token_pieces(docs: DataFrame, path: str | None = None, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, ids) of every whole text, ids as little-endian unsigned 32-bit numbers.

    A text gets ``end_id`` after its last token; a null text counts as empty. Only what is longer than ``capacity``
    is cut, into pieces of that length and one rest.
    """
    path = path or tokenizer_path("word_bpe_49k.json")
    kept = docs.select("doc_id", text_or_empty(docs).alias("text"))
    id_type = kept.schema["doc_id"].dataType.simpleString()
    end = end_id.to_bytes(4, "little")
    small_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        for batch in batches:
            row, piece, start, ids = [], [], [], []
            for at, value in enumerate(batch.column(1)):
                found = encoder.encode(value.as_py()) + end
                for k in range(0, len(found), 4 * capacity):
                    row.append(at)
                    piece.append(k // (4 * capacity))
                    start.append(k // 4)
                    ids.append(found[k:k + 4 * capacity])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "piece", "start", "ids"])

    return kept.mapInArrow(tidy(encode), f"doc_id {id_type}, piece int, start long, ids binary")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers: largest items first, each into the open bin that it leaves the least room in."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    has_room, bins = 0, []
    for item in sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True):
        size = sizes[item]
        fitting = has_room >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            number = room[left].pop()
            if not room[left]:
                has_room ^= 1 << left
            bins[number].append(item)
        else:
            left, number = capacity, len(bins)
            bins.append([item])
        left -= size
        if left:
            if not room[left]:
                has_room |= 1 << left
            room[left].append(number)
    return bins


def _packed(batches: Iterator[pa.RecordBatch], capacity: int, full_from: int, last: bool,
            run: int) -> Iterator[pa.RecordBatch]:
    """Pack bins (size, items, offsets) of one partition, in runs of at most ``run`` at a time."""
    schema = pa.schema([("full", pa.bool_()), ("size", pa.int64()), ("items", pa.list_(pa.int64())),
                        ("offsets", pa.list_(pa.int64()))])

    def merge(pool):
        done, rest = [], []
        for members in best_fit([b[0] for b in pool], capacity):
            size, items, offsets = 0, [], []
            for m in members:
                items += pool[m][1]
                offsets += [size + o for o in pool[m][2]]
                size += pool[m][0]
            (done if size >= full_from else rest).append((size, items, offsets))
        return done, rest

    def rows(bins, full):
        for k in range(0, len(bins), 5000):
            part = bins[k:k + 5000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([full] * len(part), pa.bool_()), *(
                    pa.array([b[i] for b in part], schema.field(i + 1).type) for i in range(3))], schema=schema)

    pool = []
    for batch in batches:
        pool += zip(*(batch.column(i).to_pylist() for i in range(3)))
        if len(pool) >= run:
            done, pool = merge(pool)
            yield from rows(done, True)
            if len(pool) >= run // 2:  # they fit with nothing here: leave them to the next round
                yield from rows(pool, last)
                pool = []
    done, rest = merge(pool)
    yield from rows(done, True)
    yield from rows(rest, last)


def pack(items: DataFrame, capacity: int = CAPACITY, nearly: float = 0.995, fan_in: int = 8,
         task_items: int = 200_000) -> DataFrame:
    """Pack items (item long, length long, 1 to ``capacity``) into bins: (item, sequence_id, offset).

    ``items`` should be a written table, since its partitions are packed as they are. A sequence's id is the number
    of one of its items. ``nearly`` is the share of the capacity from which a bin leaves before the last round.
    """
    full_from, bins, rounds = math.ceil(nearly * capacity), None, []
    todo = items.select(F.col("length").alias("size"), F.array("item").alias("items"),
                        F.array(F.lit(0).cast("long")).alias("offsets"))
    parts = todo.rdd.getNumPartitions()
    while True:
        last = parts <= 1

        def work(batches, last=last):
            return _packed(batches, capacity, full_from, last, task_items)

        bins = written(todo.mapInArrow(work, BIN), "bins")
        rounds.append(bins)
        if last:
            break
        left = bins.where("not full")
        n = left.count()
        narrowed = max(math.ceil(parts / fan_in), math.ceil(n / task_items))
        if narrowed >= parts:  # so many bins fit with no other that one task cannot hold them
            break
        parts = narrowed
        todo = left.select("size", "items", "offsets").repartition(parts)
    out = rounds[-1]
    for bins in rounds[:-1]:
        out = out.unionByName(bins.where("full"))
    pairs = F.explode(F.arrays_zip("items", "offsets"))
    return out.select(F.element_at("items", 1).alias("sequence_id"), pairs.alias("p")).select(
        F.col("p.items").alias("item"), "sequence_id", F.col("p.offsets").alias("offset"))


def packed_pieces(pieces: DataFrame, **pack_args) -> DataFrame:
    """``pieces`` (any columns, with ``length``) with sequence_id and offset. Rows are numbered when first written."""
    numbered = written(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    places = pack(numbered.select("item", "length"), **pack_args)
    return numbered.join(places, "item").drop("item")
