"""Line dedup by an exact set-similarity join.

A line is the set of its lower-cased words. A line goes if an earlier line of the corpus, in order of document and
place, has a Jaccard similarity of at least ``threshold`` with it; the earliest always stays.

1. Words are ordered by rarity. The order comes from counts of all words in 2^18 hash buckets, a table of fixed size
   that travels with the tasks; any fixed order gives right results, a good one gives few candidates.
2. Equal sets collapse to their earliest line by one aggregate.
3. Prefix filter. Similar lines share a word among the first size - ceil(t * size) + 1. Lines travel under these words
   with their size and a sketch of 128 bits, on which each word that only one of two lines has flips one bit. Pairs
   are held against the length, positional and sketch filters where they meet; none of these loses a match.
4. Of the four words with the smallest hashes, similar lines mostly share three. Under each three of them a line meets
   the ``NEAREST`` lines before it, and the one of the nearest sketch is verified. In a family of near copies most lines
   find their match there, by work that follows their number. (The rarest words would not do: edits are rare words.)
5. What then has no match meets all lines under all words of its prefix.

Candidates are verified on their words, read again from the documents concerned only.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from trendcast.llm.shared import emptied, small, small_batches, text_or_empty, tidy, whole_row, written

# A word's number: its class of frequency, then its length modulo 32, the longest first, then bits of its hash.
BUCKET_BITS, HASH_BITS, LENGTH_BITS = 18, 51, 5
BUCKETS = 1 << BUCKET_BITS
LEAST_HASHES, NEAREST = 4, 8
PIECE_BYTES = 4 << 20  # of texts that are split into words together
KEY = ["doc_id", "place"]


def _words(line: Column) -> Column:
    """The words of a line and, where white space is not a single space, empty strings."""
    low = F.lower(line)
    # A pattern of one letter is split without a regular expression.
    plain = F.when(low.rlike(r"[\x09-\x0D]"), F.translate(low, "\t\n\x0b\x0c\r", " " * 5)).otherwise(low)
    return F.split(plain, " ", -1)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts, in the last column, have about ``PIECE_BYTES`` each."""
    ends = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + PIECE_BYTES, side="right")))
        yield batch.slice(start, end - start)
        start = end


def _split_words(texts: pa.Array) -> pa.ListArray:
    """As ``_words``, of lower-cased texts."""
    for white in "\t\n\x0b\x0c\r":
        texts = pc.replace_substring(texts, white, " ")
    return pc.split_pattern(texts, " ")


def _hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(np.array(words.to_pylist(), dtype=object), categorize=False)


def rarity(docs: DataFrame) -> np.ndarray:
    """For each word bucket a class of frequency, 0 for the rarest: an array of fixed size, from all words of all
    documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for piece in _pieces(batch):
                counts = pc.list_flatten(_split_words(piece.column(0))).value_counts()
                words, n = counts.field("values"), counts.field("counts").to_numpy()
                filled = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
                found = (_hashes(words) & np.uint64(BUCKETS - 1)).astype(np.int64)[filled]
                total += np.bincount(found, n[filled], BUCKETS).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", "n"])

    texts = docs.select(F.lower(text_or_empty(docs)).alias("low"))
    counts = texts.mapInArrow(tidy(count), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = counts.toArrow()  # a row a bucket at most
    classes = np.zeros(BUCKETS, dtype=np.int8)
    classes[found["bucket"].to_numpy()] = np.minimum(127, np.ceil(4 * np.log2(found["n"].to_numpy())))
    return classes


def _ranked(words: pa.Array, classes: np.ndarray) -> np.ndarray:
    """Words as numbers, rarest first: by class, then by length, then by hash."""
    hashed = _hashes(words)
    length = pc.utf8_length(words).to_numpy().astype(np.uint64)
    short = (length & np.uint64(31)) ^ np.uint64(31)
    rank = classes[(hashed & np.uint64(BUCKETS - 1)).astype(np.int64)].astype(np.uint64)
    bits = hashed & np.uint64((1 << HASH_BITS) - 1)
    return rank << np.uint64(HASH_BITS + LENGTH_BITS) | short << np.uint64(HASH_BITS) | bits


def _mixed(n: np.ndarray) -> np.ndarray:
    """Numbers as 64 well mixed bits (the finalizer of SplitMix64), whose sums tell sets apart."""
    n = (n ^ n >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    n = (n ^ n >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return n ^ n >> np.uint64(31)


def _first(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: np.ndarray) -> pa.ListArray:
    """The first values of each run, at most ``most``."""
    kept = np.minimum(sizes, most)
    offsets = np.concatenate([[0], np.cumsum(kept)])
    places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], kept)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values[places].astype(np.int32)))


def _line_rows(piece: pa.RecordBatch, classes: np.ndarray, threshold: float, min_words: int) -> pa.RecordBatch:
    """What ``_scanned`` gives of the lines of some documents (doc_id, digest, low)."""
    split = pc.split_pattern(piece.column(2), "\n")
    doc = pc.list_parent_indices(split).to_numpy()
    no = np.arange(len(doc)) - np.searchsorted(doc, doc)
    words = _split_words(pc.list_flatten(split))
    line, coded = pc.list_parent_indices(words).to_numpy(), pc.list_flatten(words).dictionary_encode()
    filled = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    numbers, place = np.unique(_ranked(coded.dictionary, classes), return_inverse=True)
    codes = coded.indices.to_numpy()
    named = filled[codes]
    # One sort puts the words of each line side by side, rarest first.
    keys = np.unique(line[named].astype(np.int64) * len(numbers) + place[codes[named]])
    line, token = np.divmod(keys, len(numbers) or 1)
    sizes = np.bincount(line, minlength=len(doc))
    wanted = sizes >= max(1, min_words)
    line, token = line[wanted[line]], token[wanted[line]]
    sizes = sizes[wanted]
    starts = np.cumsum(sizes) - sizes
    one = np.uint64(1)
    bit = one << (numbers >> np.uint64(BUCKET_BITS) & np.uint64(63))
    second = numbers >> np.uint64(BUCKET_BITS + 6) & one

    def combined(how, values):
        return pa.array((how.reduceat(values[token], starts) if len(starts) else values[:0]).view(np.int64))

    short = (numbers & np.uint64(0x7FFFFFFF)).astype(np.int64)
    # In each line the smallest hashes come first.
    least = np.sort(line << 31 | short[token]) & 0x7FFFFFFF
    spare = sizes - np.ceil(threshold * sizes - 1e-6).astype(np.int64)
    at = doc[wanted]
    return pa.RecordBatch.from_arrays([
        piece.column(0).take(pa.array(at)),
        pa.array((no[wanted].astype(np.int64) << 31) + piece.column(1).to_numpy()[at]),
        combined(np.add, _mixed(numbers)), pa.array(sizes, pa.int32()),
        combined(np.bitwise_xor, bit * (one - second)), combined(np.bitwise_xor, bit * second),
        # The low bits of a number tell words apart well enough here: more candidates at most.
        _first(short[token], starts, sizes, spare + 1), _first(least, starts, sizes, np.full(len(sizes), LEAST_HASHES)),
    ], ["doc_id", "place", "set_id", "size", "x", "y", "prefix", "hashes"])


def _scanned(docs: DataFrame, threshold: float, min_words: int) -> DataFrame:
    """(doc_id, place, set_id, size, x, y, prefix, hashes) of every line of ``min_words`` words: the sketch (one bit for each
    word, by six bits of its hash, in x or y by a seventh), the words of its prefix and the least word hashes."""
    classes = rarity(docs)
    small_batches(docs.sparkSession, 2000)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch):
                yield _line_rows(piece, classes, threshold, min_words)

    digest = F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF))
    return docs.select("doc_id", digest.alias("digest"), F.lower("text").alias("low")).mapInArrow(
        tidy(scan), f"doc_id {id_type}, place long, set_id long, size int, x long, y long, prefix array<int>, hashes array<int>")


def _differ(a: str, b: str) -> Column:
    """At least so many words are in one of two lines only."""
    return F.bit_count(F.col(f"{a}.x").bitwiseXOR(F.col(f"{b}.x"))) + F.bit_count(F.col(f"{a}.y").bitwiseXOR(F.col(f"{b}.y")))


def _least(a: str, b: str, threshold: float) -> Column:
    """The number of words that similar lines of these sizes share."""
    return F.ceil(F.lit(threshold / (1 + threshold)) * (F.col(f"{a}.size") + F.col(f"{b}.size")) - 1e-6)


def _may_match(a: str, b: str, threshold: float) -> Column:
    """Sketch and length filter: false only if the lines cannot be as similar as asked for."""
    sa, sb = F.col(f"{a}.size"), F.col(f"{b}.size")
    return (sa + sb - _differ(a, b) >= 2 * _least(a, b, threshold)) & (sa >= threshold * sb - 1e-6) & (
        sb >= threshold * sa - 1e-6)


def _may_start(a: str, b: str, threshold: float) -> Column:
    """Positional filter: false only if the lines cannot be as similar, or share a word before this one too."""
    rest = F.least(F.col(f"{a}.size") - F.col(f"{a}.at"), F.col(f"{b}.size") - F.col(f"{b}.at"))
    return rest >= _least(a, b, threshold)


def _similar(docs: DataFrame, lines: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The later line, b, of those ``pairs`` (a, b: lines) that are similar, with its key."""
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("line")).distinct(), "line-numbers")
    keys = written(lines.select("line", *KEY).join(small(wanted), "line", "left_semi"), "line-keys")
    ids = written(keys.select("doc_id").distinct(), "line-documents")
    some = docs.alias("d").join(small(ids).alias("i"), F.col("d.doc_id").eqNullSafe(F.col("i.doc_id")), "left_semi")
    some = _lines(some.select("doc_id", "text")).alias("l").join(
        small(keys).alias("k"), F.col("l.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("l.place") == F.col("k.place")))
    # Rows that repeat an id and a text have lines with equal keys, which are one line.
    sets = written(some.select(
        "k.line", F.array_distinct(F.transform(F.array_remove(_words(F.col("l.text")), ""), lambda w: F.xxhash64(w))).alias(
            "words")).dropDuplicates(["line"]), "line-sets")
    both = F.size(F.array_intersect("wa", "wb"))
    similar = pairs.join(sets.toDF("a", "wa"), "a").join(sets.toDF("b", "wb"), "b").where(
        both / (F.size("wa") + F.size("wb") - both) >= F.lit(threshold))
    later = written(similar.select(F.col("b").alias("line")).distinct(), "line-later")
    found = written(keys.join(small(later), "line", "left_semi"), "line-matches")
    emptied(wanted, keys, ids, sets, later)
    return found


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, place, text) of every line. ``place`` orders the lines of an id; it holds the line's number, then bits
    of a hash of the text, so that different texts under one id keep apart. Rows with the same id and text count as one
    document."""
    text = text_or_empty(docs)
    digest = F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF))
    rows = docs.select("doc_id", digest.alias("digest"), F.posexplode(F.split(text, "\n", -1)).alias("no", "text"))
    return rows.select("doc_id", (F.shiftleft(F.col("no").cast("long"), 31) + F.col("digest")).alias("place"), "text")


def repeated_lines(docs: DataFrame, threshold: float = 0.8, min_words: int = 1) -> DataFrame:
    """(doc_id, place) of the lines that have a similar earlier line. Lines of fewer than ``min_words`` different
    words, and so empty ones, are never among them. The threshold may be from 0.75 to 1."""
    if not 0.75 <= threshold <= 1:
        raise ValueError("the keys hold for thresholds from 0.75 to 1")
    docs = docs.select("doc_id", text_or_empty(docs).alias("text"))
    rows = _scanned(docs, threshold, min_words)
    lines = written(rows.withColumn("line", F.monotonically_increasing_id()), "lines")

    # Of equal sets the earliest line goes on.
    equal = ["set_id", "size"]
    repeats = written(lines.groupBy(*equal).count().where("count > 1").drop("count"), "line-repeats")
    several = lines.select(*equal, "line", *KEY).join(small(repeats), equal, "left_semi")
    heads = written(several.groupBy(*equal).agg(F.min(F.struct(*KEY, "line")).alias("head")), "line-heads")
    others = written(several.join(small(heads), equal).where("line != head.line").select(
        "line", *KEY, (F.struct(*KEY) != F.struct("head.doc_id", "head.place")).alias("gone")), "line-copies")
    copies = others.where("gone").select(*KEY)
    # Lines of fewer words have only equal lines as similar ones. The others are numbered in the order of the corpus.
    carried = ["line", "size", "x", "y"]
    firsts = lines.where((1 - threshold) * F.col("size") >= threshold - 1e-6).join(
        small(others.select("line")), "line", "left_anti").orderBy(*KEY)
    firsts = written(firsts.select(*KEY, F.monotonically_increasing_id().alias("line"), *carried[1:], "prefix", "hashes"),
                     "line-firsts")
    copies = written(copies, "line-repeated")
    emptied(lines, repeats, heads, others)

    hashes = [F.get("hashes", F.lit(i)) for i in range(LEAST_HASHES)]
    threes = F.array(*[F.xxhash64(*some) for some in itertools.combinations(hashes, LEAST_HASHES - 1)])
    order = Window.partitionBy("key").orderBy("line")
    before = F.array(*[F.lag(F.struct(*carried), i).over(order) for i in range(1, NEAREST + 1)])
    met = firsts.select(*carried, F.explode(threes).alias("key")).withColumn("before", before)
    met = met.select(F.struct(*carried).alias("b"), F.explode("before").alias("a")).where(
        F.col("a").isNotNull() & _may_match("a", "b", threshold))
    met = met.select(F.col("b.line").alias("b"), F.col("a.line").alias("a"), _differ("a", "b").alias("differ"))
    near = written(met.groupBy("b").agg(F.min_by("a", "differ").alias("a")), "line-pairs")
    close = _similar(docs, firsts, near, threshold)

    # Matched lines look for nobody, but later ones meet them. Both sides of the join have the same columns before their
    # groups are counted, so that one shuffle by word serves both: ``mark`` is twice the place, odd for a matched line.
    known = firsts.join(small(close.select("line", F.lit(1).alias("found"))), "line", "left")
    groups = known.select(*carried, "prefix", F.coalesce("found", F.lit(0)).alias("found"), F.posexplode("prefix").alias("at", "key"))
    groups = groups.select(*carried, (2 * F.col("at") + F.col("found")).alias("mark"), "key",
                           F.coalesce(F.get("prefix", F.col("at") - 1), F.lit(-1)).alias("last")).withColumn(
        "n", F.count("*").over(Window.partitionBy("key"))).where("n > 1").withColumn("at", F.shiftright("mark", 1))
    a, b = groups.alias("a"), groups.where("mark % 2 = 0").alias("b")
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.line") < F.col("b.line"))
                   & _may_match("a", "b", threshold) & _may_start("a", "b", threshold)
                   # Lines whose words before this one are equal too have met there.
                   & ((F.col("a.last") != F.col("b.last")) | (F.col("a.last") < 0)))
    far = written(pairs.select(F.col("a.line").alias("a"), F.col("b.line").alias("b")).distinct(), "line-pairs")
    last = _similar(docs, firsts, far, threshold)
    out = copies.unionByName(close.select(*KEY)).unionByName(last.select(*KEY))
    out = written(out.distinct(), "repeated-lines")
    emptied(firsts, copies, near, close, far, last)
    return out


def dedup_lines(docs: DataFrame, threshold: float = 0.8, min_words: int = 1) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, and the columns ``n_lines`` and ``n_removed``, which
    replace any of those names. A null text stays null and has no lines."""
    # A place is the number of a line, then a digest of the text.
    removed = repeated_lines(docs, threshold, min_words).groupBy(
        F.col("doc_id").alias("r_id"), F.col("place").bitwiseAND(F.lit(0x7FFFFFFF)).alias("r_digest")).agg(
        F.collect_list(F.shiftright("place", 31).cast("int")).alias("r_numbers"))
    removed = small(removed)
    kept_columns = docs.drop("n_lines", "n_removed")
    rows = kept_columns.select(whole_row(kept_columns))
    whole = F.col("row.text")
    digest = F.xxhash64(F.coalesce(whole, F.lit(""))).bitwiseAND(F.lit(0x7FFFFFFF))
    joined = rows.join(removed, F.col("row.doc_id").eqNullSafe(F.col("r_id")) & (digest == F.col("r_digest")), "left")
    lines = F.split(whole, "\n", -1)
    # Inside the lambda stands nothing that is worked out again for each line.
    kept = F.filter(lines, lambda line, i: ~F.array_contains("r_numbers", i))
    text = F.when(F.col("r_numbers").isNull(), whole).otherwise(F.array_join(kept, "\n"))
    none = whole.isNull()
    # Not named row again: inside the lambdas that name would mean the new one.
    out = joined.select(F.col("row").withField("text", text).alias("changed"),
                        F.when(none, 0).otherwise(F.size(lines)).alias("n_lines"),
                        F.when(none | F.col("r_numbers").isNull(), 0).otherwise(F.size("r_numbers")).alias("n_removed"))
    return out.select("changed.*", "n_lines", "n_removed")
