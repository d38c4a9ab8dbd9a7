"""SimHash near-dedup by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into segments of 22, 21 and 21 bits, read as vectors of 23 bits. The perfect Golay
code has one codeword within 3 bits of every vector. A vector's list holds its codewords within 4 bits: one, or six
where the nearest is 3 bits away. If two vectors differ in one bit, the nearest codeword of each is in the other's
list; if they differ in two bits, their lists meet.

At most 4 different bits over three segments leave these cases, by the pigeonhole principle:
- two segments with one error at most: keys (nearest, each of the list) and (each of the list, nearest) of every pair;
- else one segment without error and two with 2 each: keys (segment itself, each of the next one's list).

Distinct fingerprints are sent out under their keys, at most 51 each. Groups are read as sorted streams; fingerprints
of a group are compared and only a spanning forest of their links leaves, so a group of g gives less than g rows.
Groups above ``GROUP`` members are not held: their members are linked through all fingerprints within two bits,
since two of them differ in 4 bits or fewer exactly if they share such a neighbour; likewise for smaller distances.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trendcast.llm.shared import components, small_batches, text_or_empty, tidy, written

SHINGLE, SEED = 4, 42
GROUP = 8192
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned fingerprint of a text; 0 without words."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    last = min(shingle, len(words)) - 1
    cuts = zip((ends - sizes)[: len(words) - last].tolist(), ends[last:].tolist())
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in cuts), np.uint64, len(words) - last)
    votes = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k:k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * votes > len(hashes)).tolist())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp) of every whole text, fp as a signed long; a null text counts as empty."""
    kept = docs.select("doc_id", text_or_empty(docs).alias("text"))
    small_batches(docs.sparkSession)
    id_type = kept.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(v.as_py(), shingle, seed) for v in batch.column(1)]
            fps = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    return kept.mapInArrow(tidy(work), f"doc_id {id_type}, fp long")


class Golay:
    """Lists of codeword numbers near vectors of 23 bits."""

    def __init__(self):
        high = np.arange(4096, dtype=np.int64)
        rest = high << 11
        for bit in range(22, 10, -1):
            rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
        self.remainder = rest  # of a vector's upper 12 bits
        near = [[] for _ in range(2048)]
        for weight in range(5):
            for bits in combinations(range(23), weight):
                error = sum(1 << b for b in bits)
                near[self.syndrome(np.int64(error))].append(error)
        self.errors = np.array([(e * 6)[:6] if len(e) == 1 else e for e in near], np.int64)

    def syndrome(self, v):
        return self.remainder[v >> 11] ^ (v & 2047)

    def near(self, v: np.ndarray) -> np.ndarray:
        """Numbers of the codewords within 4 bits of each vector, nearest first, in 6 columns (one alone is repeated)."""
        return (v[:, None] ^ self.errors[self.syndrome(v)]) >> 11


def keys_of(fps: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(keys, row numbers), without repeats."""
    unsigned = fps.view(np.uint64)
    parts = [((unsigned >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    near = [golay.near(p) for p in parts]
    columns = []
    for kind, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        columns += [(kind << 36) | (near[i][:, :1] << 12) | near[j], (kind << 36) | (near[i][:, 1:] << 12) | near[j][:, :1]]
    for i in range(3):
        columns.append(((3 + i) << 36) | (parts[i][:, None] << 12) | near[(i + 1) % 3])
    keys = np.sort(np.concatenate(columns, axis=1), axis=1)
    first = np.ones(keys.shape, bool)
    first[:, 1:] = keys[:, 1:] != keys[:, :-1]
    return keys[first], np.nonzero(first)[0]


def forest(members: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what differs in ``distance`` bits or fewer, each to one found before it."""
    left, out = members.copy(), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        root = queue[0]
        while queue and len(left):
            close = np.bitwise_count(left ^ queue.pop()) <= distance
            found, left = left[close], left[~close]
            queue.extend(found)
            out += [(root, f) for f in found]
    return out


def _linked(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) from rows (key, fp) sorted by both; members of too large groups as (fp, null)."""
    names = ["a", "b"]

    def rows(a, b, crowded=()):
        a, b = np.asarray(a, np.uint64).view(np.int64), np.asarray(b, np.uint64).view(np.int64)
        more = np.asarray(crowded, np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, more])), pa.concat_arrays([
            pa.array(b), pa.nulls(len(more), pa.int64())])], names)

    def groups(keys, fps):
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        begins, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
        sizes = ends - begins
        two = begins[sizes == 2]
        two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= distance]
        a, b, crowded = [fps[two]], [fps[two + 1]], []
        for x, y in zip(begins[sizes > 2].tolist(), ends[sizes > 2].tolist()):
            if y - x > GROUP:
                crowded.append(fps[x:y])
                continue
            found = forest(fps[x:y], distance)
            if found:
                pair = np.array(found, np.uint64)
                a.append(pair[:, 0])
                b.append(pair[:, 1])
        return rows(np.concatenate(a), np.concatenate(b), np.concatenate(crowded) if crowded else ())

    held_keys, held_fps, crowded_key = np.empty(0, np.int64), np.empty(0, np.uint64), None
    for batch in batches:
        keys = np.concatenate([held_keys, batch.column(0).to_numpy(zero_copy_only=False)])
        fps = np.concatenate([held_fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(keys):
            continue
        start = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
        if crowded_key is not None:
            end = int(np.searchsorted(keys, crowded_key, "right"))
            yield rows((), (), fps[:end])
            keys, fps, start = keys[end:], fps[end:], max(0, start - end)
            if not len(keys):
                held_keys, held_fps = keys, fps
                continue
            crowded_key = None
        if start:
            yield groups(keys[:start], fps[:start])
        held_keys, held_fps = keys[start:], fps[start:]
        if len(held_keys) > GROUP:
            crowded_key = held_keys[0]
            yield rows((), (), held_fps)
            held_keys, held_fps = held_keys[:0], held_fps[:0]
    if len(held_keys):
        yield groups(held_keys, held_fps)


def _neighbourhoods(batches: Iterator[pa.RecordBatch], radius: int = 2) -> Iterator[pa.RecordBatch]:
    """(z, fp) for every fingerprint z within ``radius`` bits of fp, two at most."""
    one = np.uint64(1)
    flips = [np.uint64(0)] + [one << np.uint64(i) for i in range(64) if radius]
    flips += [(one << np.uint64(i)) | (one << np.uint64(j)) for i, j in combinations(range(64), 2) if radius > 1]
    flips = np.array(flips, np.uint64)
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for k in range(0, len(fps), 64):
            part = fps[k:k + 64]
            z = (part[:, None] ^ flips).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(z.view(np.int64)), pa.array(
                np.repeat(part, len(flips)).view(np.int64))], ["z", "fp"])


def links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that differ in ``distance`` bits or fewer, up to 4."""
    if not 0 <= distance <= 4:
        raise ValueError("the keys hold for up to 4 different bits")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = Golay()
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for k in range(0, len(values), 4096):
                part = values[k:k + 4096]
                keys, at = keys_of(part, golay)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[at])], ["key", "fp"])

    sent = fps.select("fp").mapInArrow(tidy(send), "key long, fp long").repartition("key").sortWithinPartitions("key", "fp")
    found = written(sent.mapInArrow(lambda b: _linked(b, distance), "a long, b long"), "simhash-links")
    crowded = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    found = found.where("b is not null").distinct()
    return found if crowded.isEmpty() else found.unionByName(crowded_links(crowded, distance))


def crowded_links(crowded: DataFrame, distance: int) -> DataFrame:
    """(a, b) among the members of too large groups. Two differ in ``distance`` bits or fewer exactly if a fingerprint
    is within half of it, rounded down, of the one and within the rest of it of the other. All that are within the
    rest are linked to the smallest within the half."""
    half = distance // 2
    near = crowded.mapInArrow(lambda b: _neighbourhoods(b, distance - half), "z long, fp long")
    within = F.bit_count(F.col("z").bitwiseXOR(F.col("fp"))) <= half
    least = near.groupBy("z").agg(F.min(F.when(within, F.col("fp"))).alias("a"), F.count("*").alias("n")).where(
        "n > 1 and a is not null")
    return near.join(least, "z").select("a", F.col("fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame, distance: int = 4, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``grouped`` without ``root``."""
    return grouped(docs, distance, shingle, seed).drop("root")


def grouped(docs: DataFrame, distance: int = 4, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp, root, component_id), a row for each of ``docs``: documents whose fingerprints differ in ``distance`` bits or fewer are linked, and a
    component is named by its smallest id. Texts without words share the fingerprint 0 and are linked like others.
    Null ids are links too, but name a component only if it has no other id. ``root`` is the smallest fingerprint of a
    component; it tells components apart that one repeated id names."""
    fps = written(fingerprints(docs, shingle, seed), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(links(distinct, distance), "simhash-components")
    labelled = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    names = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps.join(labelled.join(names, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "fp", "root", "component_id")


def hexadecimal(fp) -> "F.Column":
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
