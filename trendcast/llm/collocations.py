"""Collocation mining from one count of longest windows.

Texts are read twice. The first reading counts words. The second emits, for each word, the window of it and its next
three words in the piece; places beyond the piece, and from the first rare word on, are padding, since a phrase with a
rare word is rare. Equal windows are counted once, and ROLLUP sums those counts over successively shorter prefixes,
so phrases of two and three words need no emission of their own.

Words travel as numbers: ranks in a dictionary of at most ``dictionary`` frequent words, or, where there are more
than that, 64-bit hashes, whose collisions are looked for and avoided by another salt. Both give the same result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from trendcast.llm.shared import small_batches, text_or_empty, tidy, written

ORDER = 4
PLACES = [f"w{i}" for i in range(1, ORDER + 1)]
DICTIONARY = 400_000
FLUSH = 1_000_000
SPAN = 1 << 20
# Words that make up more than this part of all words are common; their number is bounded by its inverse.
COMMON, SHARES = 1 / 5000, 64

# Pieces end at these; ASCII capitals are lowered; byte 0xFF, which UTF-8 never has, stands for the end of a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
LETTERS = bytes(0xFF if b in ENDS else b + 32 if 65 <= b <= 90 else b for b in range(256))
END = b"\xff"


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, ``END`` after each piece, a bounded part of the text at a time."""
    at = 0
    while at < len(text):
        stop = len(text)
        if stop - at > SPAN:
            stop = max(text.rfind(b" ", at, at + SPAN), text.rfind(b"\n", at, at + SPAN)) + 1
            if stop <= at:  # no white space here: take up to the next
                after = [p for p in (text.find(b" ", at + SPAN), text.find(b"\n", at + SPAN)) if p >= 0]
                stop = min(after) + 1 if after else len(text)
        yield text[at:stop].translate(LETTERS).replace(END, b" \xff ").split()
        at = stop


def read(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
                       text_or_empty(docs).cast("binary").alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over whole texts; the row with a null word counts all words of its language."""

    def rows(counts: dict[str, Counter]) -> pa.RecordBatch:
        langs, names, numbers = [], [], []
        for lang, counter in counts.items():
            counter.pop(END, None)
            langs += [lang] * (len(counter) + 1)
            names += [None, *counter]
            numbers += [sum(counter.values()), *counter.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(names, pa.binary()).cast(pa.string()), pa.array(numbers, pa.int64())],
            ["lang", "word", "n"])

    def count(batches):
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counter = counts.setdefault(lang, Counter())
                for part in words(text.as_py()):
                    counter.update(part)
                    if len(counter) > FLUSH:
                        yield rows({lang: counter})
                        counter = counts[lang] = Counter()
            if sum(map(len, counts.values())) > FLUSH:
                yield rows(counts)
                counts = {}
        if counts:
            yield rows(counts)

    return read(docs).mapInArrow(tidy(count), "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n"))


def hashed(salt: str) -> Column:
    code = F.xxhash64(F.lit(salt), F.col("lang"), F.col("word"))
    return F.when(code == 0, F.lit(1)).otherwise(code)


class Numbers:
    """Numbers of the words of a language: ranks, 0 for rare words, or hashes, as ``hashed`` gives them."""

    def __init__(self, ranks: dict[str, dict[bytes, int]] | None, salt: str, common: np.ndarray):
        self.ranks, self.salt, self.common = ranks, salt, common
        self.known: dict[str, dict[bytes, int]] = {}

    def of(self, lang: str, part: list[bytes]) -> np.ndarray:
        if self.ranks is not None:
            numbers = self.ranks.get(lang, {})
            return np.fromiter(map(numbers.get, part, repeat(0)), np.int64, len(part))
        from xxhash import xxh64_intdigest

        known = self.known.setdefault(lang, {})
        if len(known) > FLUSH:
            known.clear()
        seed = xxh64_intdigest(lang.encode(), xxh64_intdigest(self.salt.encode(), 42))
        for word in set(part).difference(known):
            code = xxh64_intdigest(word, seed)
            known[word] = 0 if word == END else (code - (1 << 64) if code >= 1 << 63 else code) or 1
        return np.fromiter(map(known.__getitem__, part), np.int64, len(part))


def windows(docs: DataFrame, numbers: Numbers) -> DataFrame:
    """(w1, w2, w3, w4, share, f): the windows of every word that another follows in its piece; 0 is padding.

    Equal windows that lie close together are counted here, f is their number. ``share`` is 0, but for windows that begin
    with two common words, which have a share from 1 to ``SHARES`` by their last two words."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(numbers)

    def lead(ids: np.ndarray, last: int) -> pa.RecordBatch:
        """The windows that begin before ``last``."""
        padded = np.concatenate([ids, np.zeros(ORDER, np.int64)])
        begins = np.flatnonzero((padded[:last] != 0) & (padded[1:last + 1] != 0))
        columns, going = [padded[begins]], np.ones(len(begins), bool)
        for k in range(1, ORDER):
            going = going & (padded[begins + k] != 0)
            columns.append(np.where(going, padded[begins + k], 0))
        counted = pa.table(columns, PLACES).group_by(PLACES, use_threads=False).aggregate([([], "count_all")])
        w1, w2, w3, w4 = (counted[p].to_numpy() for p in PLACES)
        common = np.isin(w1, shared.value.common) & np.isin(w2, shared.value.common)
        share = np.where(common, 1 + (w3 * 31 + w4) % SHARES, 0)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(w) for w in (w1, w2, w3, w4)), pa.array(share.astype(np.int32)),
             pa.array(counted["count_all"].to_numpy())], [*PLACES, "share", "f"])

    def emit(batches):
        numbers = shared.value
        gap = np.zeros(1, np.int64)
        held, size = [], 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in words(text.as_py()):
                    ids = numbers.of(lang, part)
                    held.append(ids)
                    size += len(ids)
                    if size > SPAN:  # the last words also begin windows that reach into what follows
                        ids = np.concatenate(held)
                        yield lead(ids, len(ids) - (ORDER - 1))
                        held, size = [ids[-(ORDER - 1):]], ORDER - 1
                held.append(gap)
                size += 1
        if held:
            ids = np.concatenate(held)
            yield lead(ids, len(ids))

    return read(docs).mapInArrow(tidy(emit), ", ".join(f"{p} long" for p in PLACES) + ", share int, f long")


def _numbered(vocabulary: DataFrame, counts, dictionary: int, least: int) -> tuple[DataFrame, Numbers]:
    """(code, lang, word, n) of the frequent words, and the numbers of all."""
    frequent = vocabulary.where(F.col("word").isNotNull())
    every = vocabulary.where(F.col("word").isNull()).agg(F.sum("n")).first()[0] or 0

    def common(codes: DataFrame) -> np.ndarray:
        return np.array([r["code"] for r in codes.where(F.col("n") > every * COMMON).select("code").collect()], np.int64)

    if frequent.count() <= dictionary:  # few enough to number here
        rows = sorted(frequent.select("n", "lang", "word").toArrow().to_pylist(), key=lambda r: (-r["n"], r["lang"], r["word"]))
        ranks: dict[str, dict[bytes, int]] = {}
        for code, r in enumerate(rows, 1):
            ranks.setdefault(r["lang"], {})[r["word"].encode()] = code
        listed = pa.table({"code": pa.array(range(1, len(rows) + 1), pa.int64()), **{
            k: pa.array([r[k] for r in rows], t) for k, t in (("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()))}})
        codes = written(vocabulary.sparkSession.createDataFrame(listed), "word-ranks")
        return codes, Numbers(ranks, "", common(codes))
    everything = written(counts().where(F.col("word").isNotNull()).select("lang", "word", "n"), "all-words")
    salt = 0
    while not everything.groupBy(hashed(str(salt))).count().where("count > 1").isEmpty():
        salt += 1
    codes = everything.where(F.col("n") >= least).withColumn("code", hashed(str(salt)))
    return codes, Numbers(None, str(salt), common(codes))


def phrase_counts(docs: DataFrame, numbers: Numbers, least: int) -> DataFrame:
    """(w1, ..., w4, f) of all phrases of two words and more with f >= ``least``; shorter ones end in zeros."""
    found = windows(docs, numbers)
    if numbers.ranks is not None:  # two ranks fit one number, in as few bits as they take: narrower rows in the shuffle
        bits = sum(map(len, numbers.ranks.values())).bit_length()
        low = F.lit((1 << bits) - 1)
        first, last = ["w12"], ["w34"]
        found = found.select(F.shiftleft("w1", bits).bitwiseOR(F.col("w2")).alias("w12"), "share",
                             F.shiftleft("w3", bits).bitwiseOR(F.col("w4")).alias("w34"), "f")
        w1, w2 = F.shiftright("w12", bits), F.col("w12").bitwiseAND(low)
        w3, w4 = F.shiftright("w34", bits), F.col("w34").bitwiseAND(low)
    else:
        first, last = PLACES[:2], PLACES[2:]
        w1, w2, w3, w4 = (F.col(p) for p in PLACES)
    pair, none = [w1.alias("w1"), w2.alias("w2")], F.lit(0).cast("long")
    counted = found.repartition(*first, "share").groupBy(*first, "share", *last).agg(F.sum("f").alias("f"))
    # Judged on the counts, so that the filters stay above the aggregates and all uses share one shuffle.
    enough = F.col("f") >= least
    longest = counted.where(F.when(enough, w4).otherwise(none) != 0).select(*pair, w3.alias("w3"), w4.alias("w4"), "f")
    threes = counted.groupBy(*first, "share", w3.alias("w3")).agg(F.sum("f").alias("f"))
    twos = counted.groupBy(*first, "share").agg(F.sum("f").alias("f")).withColumn("w3", none)
    whole = F.col("share") == 0

    def summed(part: DataFrame) -> DataFrame:
        """Sums of the shares. What is whole and rare goes before the shuffle."""
        rest = part.where(F.when(whole, F.col("f")).otherwise(F.lit(least)) >= least)
        return rest.groupBy(*first, "w3").agg(F.sum("f").alias("f")).where(enough).select(*pair, "w3", none.alias("w4"), "f")

    threes = threes.where(F.when(F.col("f") > 0, F.col("w3")).otherwise(none) != 0)
    return longest.unionByName(summed(threes)).unionByName(summed(twos))


def _parts(first: int, last: int) -> Column:
    """The phrase of places ``first`` to ``last``, padded."""
    return F.struct(*[(F.col(PLACES[first + i]) if first + i < last else F.lit(0).cast("long")).alias(f"p{i + 1}")
                      for i in range(ORDER)])


def _cuts(places: int) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("k"), _parts(0, k).alias("left"), _parts(k, places).alias("right"))
                     for k in range(1, places)])


def _by_length(make) -> Column:
    return F.when(F.col("w3") == 0, make(2)).when(F.col("w4") == 0, make(3)).otherwise(make(4))


def _keyed(known: DataFrame, side: str) -> DataFrame:
    return known.select(*[F.col(p).alias(f"{side}{i + 1}") for i, p in enumerate(PLACES)], F.col("f").alias(f"{side}_f"))


def _joined(rows: DataFrame, known: DataFrame, field: str, side: str) -> DataFrame:
    on = [F.col(f"{field}.p{i}") == F.col(f"{side}{i}") for i in range(1, ORDER + 1)]
    return rows.join(_keyed(known, side), on).drop(*[f"{side}{i}" for i in range(1, ORDER + 1)])


def cohesion(phrases: DataFrame, known: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each phrase: (w1, ..., w4, a, score, l, r), the first of equal ones.

    Every part of a frequent phrase is itself frequent, so ``known`` has it.
    """
    cut = phrases.select(*PLACES, F.col("f").alias("a"), F.explode(_by_length(_cuts)).alias("cut"))
    both = _joined(_joined(cut, known, "cut.left", "l"), known, "cut.right", "r")
    score = F.expr("cast(2000000 * cast(a as decimal(20, 0)) as decimal(28, 0)) div (cast(l_f as decimal(20, 0)) + r_f)")
    worst = F.min(F.struct(score.alias("score"), F.col("cut.k").alias("k"), F.col("l_f").alias("l"), F.col("r_f").alias("r")))
    return both.groupBy(*PLACES, "a").agg(worst.alias("worst")).select(
        *PLACES, "a", F.col("worst.score").alias("score"), F.col("worst.l").alias("l"), F.col("worst.r").alias("r"))


def swallowed(phrases: DataFrame) -> DataFrame:
    """(s1, ..., s4, longer): for each phrase within longer ones, the largest count of those."""
    def inner(places):
        spans = [(i, j) for i in range(places) for j in range(i + 2, places + 1) if j - i < places]
        return F.array(*[_parts(i, j) for i, j in spans])

    longer = phrases.where("w3 != 0").select(
        "f", F.explode(F.when(F.col("w4") == 0, inner(3)).otherwise(inner(4))).alias("s"))
    return longer.groupBy(*[F.col(f"s.p{i}").alias(f"s{i}") for i in range(1, ORDER + 1)]).agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, dictionary: int = DICTIONARY) -> DataFrame:
    """The ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    ``docs`` has ``lang`` and ``text``; other columns are not looked at. A null text is empty, a null lang is ``und``.
    Repeated rows count as often as they stand. An empty table, or one without frequent phrases, gives no rows. Phrases of
    equal score and count go by their UTF-8 bytes. A phrase goes if a longer one that contains it is at least 80 % as
    frequent, whether that one stays or not.
    """
    docs = docs.select("lang", "text")

    def counts():
        return word_counts(docs)

    vocabulary = written(counts().where(F.col("word").isNull() | (F.col("n") >= least)), "word-counts")
    codes, numbers = _numbered(vocabulary, counts, dictionary, least)
    totals = vocabulary.where(F.col("word").isNull()).select(F.col("lang").alias("t_lang"), F.col("n").alias("t_n"))
    phrases = written(phrase_counts(docs, numbers, least), "phrases")
    zero = F.lit(0).cast("long")
    singles = codes.select(F.col("code").alias("w1"), *[zero.alias(p) for p in PLACES[1:]], F.col("n").alias("f"))
    scored = cohesion(phrases, phrases.unionByName(singles))
    inside = swallowed(phrases)
    gone = [F.col(p) == F.col(f"s{i}") for i, p in enumerate(PLACES, 1)]
    hides = F.expr("100 * cast(longer as decimal(20, 0)) >= 80 * cast(a as decimal(20, 0))")
    kept = scored.join(inside, gone + [hides], "left_anti")
    names = codes.select("code", "lang", "word")
    for place in PLACES:
        n = names.select(F.col("code").alias("c"), F.col("lang").alias(f"{place}_lang"), F.col("word").alias(f"{place}_word"))
        kept = kept.join(n, F.col(place) == F.col("c"), "inner" if place in PLACES[:2] else "left").drop("c")
    kept = kept.select(F.col("w1_lang").alias("lang"), F.concat_ws(" ", *[f"{p}_word" for p in PLACES]).alias("phrase"),
                       "a", "l", "r", "score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, best["lang"] == totals["t_lang"]).select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("t_n").alias("n"), F.col("score").cast("long"))
