"""Mixing sources to target weights.

A source is a stream of words: its documents in a pseudorandom order, read once or, for a target above its size, again
from the start. The stream is cut into blocks of equal length and the target fixes how many blocks are drawn, exactly.
A splitting tree deals those block quotas to the output shards: a node passes a multivariate hypergeometric draw of
its blocks to its left half and the rest to its right half, so that the shards get what one uniform shuffle of all
blocks would give them. Each shard then takes its next blocks of every source, disjoint from all other shards, and
shuffles them locally.

Only the sizes of documents are read from texts. Everything after that works on one narrow row per document, spread
over (source, slice of the order), so a source with a third of all rows is shared out like any other.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from trendcast.llm.shared import WORD, parallelism, text_or_empty, whole_row, written

WEIGHTS = (5, 2, 1)
ORDER_BITS = 60


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long")


def order_key(doc_id: Column, seed: int) -> Column:
    """A pseudorandom number of 60 bits for an id; the same on every run."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5,
                   limit: float = 2.0) -> DataFrame:
    """Targets of the sources (source, source_size): ``share`` of all sizes is split by weight; a target stops at
    ``limit`` times its source's size and the excess goes to the others by weight, until none is above.

    The fixed point gives each source ``min(limit * size, level * weight)`` with one level for all. Taking the
    sources in the order in which they fill up, the level is the largest of (share left) / (weight left).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("fills_at", "source_no")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (
        sizes.withColumn("source_no", F.row_number().over(by_name).cast("long"))
        .withColumn("weight", F.element_at(F.lit(list(weights)), ((F.col("source_no") - 1) % len(weights) + 1).cast("int")))
        .withColumn("most", F.col("source_size") * F.lit(float(limit)))
        .withColumn("fills_at", F.col("most") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", (F.col("budget") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                    / F.sum("weight").over(onward))
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least("most", F.col("level") * F.col("weight")))
        .select("source", "source_no", "source_size", "target")
    )


def sized(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, source, digest, size, order): what the mix needs of each document. A null text has no words."""
    text = text_or_empty(docs)
    return docs.select(
        "doc_id", "source", F.xxhash64(text).alias("digest"), word_count(text).alias("size"),
        order_key(docs["doc_id"], seed).alias("order"),
    )


def placed(sizes: DataFrame, slices: int, **target_args) -> DataFrame:
    """Each document's place in its source's stream: ``start`` (words before it), with the source's size and target.

    The running sum has two levels: within a slice of the pseudorandom order, and over the slices' sums. The order
    does not depend on the number of slices. ``slice_no`` and ``row_no`` name a row within its source.
    """
    rows = sizes.withColumn("slice_no", F.floor(F.col("order") / F.lit(2 ** ORDER_BITS / slices)))
    parts = rows.groupBy("source", "slice_no").agg(F.sum("size").alias("slice_size"))
    targets = source_targets(parts.groupBy("source").agg(F.sum("slice_size").alias("source_size")), **target_args)
    earlier = Window.partitionBy("source").orderBy("slice_no").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("slice_start", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)))
    parts = parts.join(targets, parts["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    within = Window.partitionBy("source", "slice_no").orderBy("order", "doc_id", "size", "digest")
    rows = rows.withColumn("row_no", F.row_number().over(within).cast("long")).withColumn(
        "within", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    p = parts.select(F.col("source").alias("p_source"), F.col("slice_no").alias("p_slice"), "slice_start",
                     "source_no", "source_size", "target")
    joined = rows.join(p, rows["source"].eqNullSafe(p["p_source"]) & (rows["slice_no"] == p["p_slice"]))
    return joined.withColumn("start", F.col("slice_start") + F.col("within")).drop(
        "p_source", "p_slice", "slice_start", "within", "order")


def let(value: Column, use) -> Column:
    """``use`` of ``value``, with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``marked`` among ``total`` items are in a draw of ``drawn`` without replacement, for a uniform u.

    Inverts the distribution from its mode outwards, by ratios of neighbouring probabilities. Both tails end 40
    standard deviations away, where a probability is below the smallest double.
    """
    def up(v, k, p):  # from k - 1 to k
        return p * (v["K"] - k + 1) * (v["D"] - k + 1) / (k * (v["N"] - v["K"] - v["D"] + k))

    def down(v, k, p):  # from k + 1 to k
        return p * (k + 1) * (v["N"] - v["K"] - v["D"] + k + 1) / ((v["K"] - k) * (v["D"] - k))

    def walk(v, ks, step, point):
        """The mass along ``ks``, and the first k at which it reaches ``point``."""
        start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("mass"), v["mode"].alias("k"))

        def further(a, k):
            return let(step(v, k, a["p"]), lambda p: F.struct(
                p.alias("p"), (a["mass"] + p).alias("mass"), F.when(a["mass"] < point, k).otherwise(a["k"]).alias("k")))

        return F.aggregate(ks, start, further)

    def limits(v):
        low, high = F.greatest(F.lit(0.0), v["D"] + v["K"] - v["N"]), F.least(v["D"], v["K"])
        mode = F.greatest(low, F.least(high, F.floor((v["D"] + 1) * (v["K"] + 1) / (v["N"] + 2)).cast("double")))
        return F.struct(
            v["N"].alias("N"), v["K"].alias("K"), v["D"].alias("D"), low.alias("low"), high.alias("high"),
            mode.cast("long").alias("mode"), (40 * F.sqrt(v["D"] * v["K"] * (v["N"] - v["K"]) / F.greatest(
                v["N"] * v["N"], F.lit(1.0))) + 40).alias("spread"))

    def sides(v):
        top = F.floor(F.least(v["high"], v["mode"] + v["spread"]))
        bottom = F.ceil(F.greatest(v["low"], v["mode"] - v["spread"]))
        none = F.array().cast("array<bigint>")
        return F.struct(
            F.when(top > v["mode"], F.sequence(v["mode"] + 1, top)).otherwise(none).alias("ups"),
            F.when(bottom < v["mode"], F.sequence(v["mode"] - 1, bottom, F.lit(-1))).otherwise(none).alias("downs"))

    def invert(v, s):
        masses = F.struct(walk(v, s["ups"], up, F.lit(0.0))["mass"].alias("above"),
                          walk(v, s["downs"], down, F.lit(0.0))["mass"].alias("below"))

        def pick(m):
            point = u * (1 + m["above"] + m["below"])
            return F.when(point <= 1, v["mode"]).when(
                point <= 1 + m["above"], walk(v, s["ups"], up, point - 1)["k"]).otherwise(
                    walk(v, s["downs"], down, point - 1 - m["above"])["k"])

        return let(masses, pick)

    numbers = F.struct(total.cast("double").alias("N"), marked.cast("double").alias("K"), drawn.cast("double").alias("D"))
    return let(numbers, lambda x: let(limits(x), lambda v: let(sides(v), lambda s: invert(v, s))))


def uniform(*parts: Column) -> Column:
    """A number in (0, 1), fixed by ``parts``."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / F.lit(2.0 ** 53)


def deal(quotas: DataFrame, shards: int, total: int, seed: int) -> DataFrame:
    """Deal the block quotas (source_no, quota) to ``shards`` shards by the splitting tree: (shard, source_no, blocks).

    A node holds shards [first, last) and the quotas of the sources that it has blocks of. Shard j has blocks
    floor(j * total / shards) up to the next shard's, so all shards are equal to within a block.
    """
    tree = quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct("source_no", "quota"))).alias("has")).select(
        F.lit(0).cast("long").alias("first"), F.lit(shards).cast("long").alias("last"), "has")

    def bound(shard):
        return F.floor(shard * F.lit(total) / F.lit(shards))

    for level in range(max(0, math.ceil(math.log2(max(1, shards))))):
        middle = F.floor((F.col("first") + F.col("last")) / 2)
        tree = tree.withColumn("middle", middle).withColumn("need", bound(F.col("middle")) - bound(F.col("first")))
        tree = tree.withColumn("total", F.aggregate("has", F.lit(0).cast("long"), lambda a, s: a + s["quota"]))
        start = F.struct(F.col("total").alias("total"), F.col("need").alias("need"),
                         F.array().cast("array<bigint>").alias("left"))

        chance = (F.lit(seed), F.lit(level), F.col("first"))

        def draw(state, source):
            u = uniform(*chance, source["source_no"])  # noqa: B023
            x = hypergeometric(state["total"], source["quota"], state["need"], u)
            return let(x, lambda got: F.struct(
                (state["total"] - source["quota"]).alias("total"), (state["need"] - got).alias("need"),
                F.concat(state["left"], F.array(got)).alias("left")))

        tree = tree.withColumn("left", F.aggregate("has", start, draw, lambda a: a["left"]))
        halves = F.when(F.col("last") - F.col("first") <= 1, F.array(
            F.struct("first", "last", "has"))).otherwise(F.array(
                F.struct("first", F.col("middle").alias("last"), F.zip_with("has", "left", lambda s, x: F.struct(
                    s["source_no"].alias("source_no"), x.alias("quota"))).alias("has")),
                F.struct(F.col("middle").alias("first"), "last", F.zip_with("has", "left", lambda s, x: F.struct(
                    s["source_no"].alias("source_no"), (s["quota"] - x).alias("quota"))).alias("has"))))
        tree = tree.select(F.explode(halves).alias("half")).select("half.first", "half.last", F.filter(
            "half.has", lambda s: s["quota"] > 0).alias("has"))
    return tree.select(F.col("first").alias("shard"), F.explode("has").alias("s")).select(
        "shard", "s.source_no", F.col("s.quota").alias("blocks"))


def mix(places: DataFrame, block_words: int = 8192, shard_blocks: int = 1024, passes: int = 2,
        seed: int = 0) -> DataFrame:
    """The mixture: one row per drawn copy of a document, with its ``shard`` and its ``position`` there.

    ``places`` comes from :func:`placed`, written once. A copy is drawn if its middle lies before the source's target,
    so a source misses its target by half a document at most, and no document is drawn more than ``passes`` times.
    A source whose target is 0 gives nothing; documents without words are drawn with their neighbours.
    """
    per_source = places.groupBy("source_no").agg(F.max("target").alias("target"))
    quotas = per_source.select("source_no", F.ceil(F.col("target") / block_words).alias("quota")).where("quota > 0")
    total = quotas.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    shards = max(1, math.ceil(total / shard_blocks))
    dealt = deal(quotas, shards, total, seed)
    upto = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = dealt.withColumn("end", F.sum("blocks").over(upto))
    blocks = ends.select("source_no", "shard", F.explode(
        F.sequence(F.col("end") - F.col("blocks"), F.col("end") - 1)).alias("block"))
    copies = places.withColumn("pass", F.explode(F.lit(list(range(passes))))).withColumn(
        "at", F.col("pass") * F.col("source_size") + F.col("start"))
    copies = copies.where(2 * F.col("at") + F.col("size") < 2 * F.col("target")).withColumn(
        "block", F.floor(F.col("at") / block_words))
    shuffled = Window.partitionBy("shard").orderBy("key", "source_no", "slice_no", "row_no", "pass")
    return (
        copies.join(blocks, ["source_no", "block"])
        .withColumn("key", F.xxhash64(F.lit(seed), "source_no", "slice_no", "row_no", "pass"))
        .withColumn("position", F.row_number().over(shuffled).cast("long"))
        .drop("key", "at")
    )


def prepared(docs: DataFrame, seed: int = 0, **target_args) -> DataFrame:
    """:func:`placed` rows of ``docs``, written to the shared folder in two steps; texts are read once."""
    sizes = written(sized(docs, seed), "mix-sizes")
    slices = 16 * parallelism(docs.sparkSession)
    return written(placed(sizes, slices, **target_args), "mix-places")


def taken(places: DataFrame, mixture: DataFrame) -> DataFrame:
    """Words the mix takes of each document: (doc_id, size, source_size, target, taken); 0 for those left out."""
    key = ["source_no", "slice_no", "row_no"]
    words = mixture.groupBy(*key).agg(F.sum("size").alias("words"))
    return places.join(words, key, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0).cast("long")).alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 0, **mix_args) -> DataFrame:
    """The mixture as rows of ``docs``, in shard order: a document stands there once for each copy drawn.

    Rows that repeat an id, a source and a text count as copies of one row. Clashing names of extra columns are kept.
    """
    def name(df):
        return F.md5(F.to_json(F.struct(df["doc_id"].alias("i"), df["source"].alias("s"))))

    draws = mix(prepared(docs, seed), seed=seed, **mix_args)
    draws = draws.withColumn("name", name(draws)).groupBy("digest", "name").agg(
        F.collect_list(F.struct("shard", "position")).alias("places"))
    same = Window.partitionBy("digest", "name").orderBy(F.lit(0))
    keyed = docs.select(F.xxhash64(text_or_empty(docs)).alias("digest"), name(docs).alias("name"), whole_row(docs))
    once = keyed.withColumn("no", F.row_number().over(same)).where("no = 1")
    return (
        once.join(draws, ["digest", "name"]).select("row", F.explode("places").alias("place"))
        .repartition(F.col("place.shard")).sortWithinPartitions("place").select("row.*")
    )
