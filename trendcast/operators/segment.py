"""Segmentation by KMeans: scaling, choice of k, assignment and segment profiles."""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from trendcast.functions.arrays import first_arg_max
from trendcast.functions.coerce import finite
from trendcast.operators import boxes, kmeans
from trendcast.operators.cleaning import present
from trendcast.operators.textvec import (
    TEXT_GRID, SvdModel, TfidfModel, add_words, english_stop_words, frequent_statistics, mean_vector, svd_of_parts,
    term_rows, tfidf_from_statistics, top_terms,
)
from trendcast.session import batches_of

# Candidate numbers of clusters, KMeans restarts, value bound.
K_VALUES = (2, 3, 4, 5, 6)
RESTARTS = 20
VALUE_BOUND = 1e6
# Rows of a tile of the all-rows silhouette, rows of it that are compared at a time, bytes of vectors that a task holds of
# the other side and that it sends to Python at a time, clusters whose sums are kept together; and centres that one
# expression carries at a time.
TILE_ROWS, PIECE_ROWS, RUN_BYTES, PAIR_BYTES, BUCKET_CLUSTERS = 2048, 128, 64 << 20, 8 << 20, 1000
# Of rows in few dimensions with few clusters: rows of a tile, tiles at most (then they have more rows), rows a tile that are
# looked at for its bounds, and nodes that distances are worked out for at a time.
BOX_DIMENSIONS, BOX_CLUSTERS, BOX_ROWS, BOXES, BOX_SAMPLE, PIECE_NODES = 8, 256, 512, 2048, 32, 8192
CENTRE_BLOCK = 1000
# Name of the column of words while texts are clustered.
WORDS = "__words"


class Segmentation(NamedTuple):
    """All rows with their cluster, the table behind the choice of k, and the profile of each cluster."""

    assigned: DataFrame
    selection: DataFrame
    profile: DataFrame
    sensitivity: DataFrame | None = None


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column; a constant column is only centred."""

    means: Mapping[str, float]
    stds: Mapping[str, float]

    def scaled(self, column: str) -> Column:
        return (F.coalesce(F.col(column).cast("double"), F.lit(0.0)) - self.means[column]) / self.stds[column]

    def transform(self, df: DataFrame, output: str = "scaled") -> DataFrame:
        return df.withColumn(output, F.array(*[finite(self.scaled(c), VALUE_BOUND) for c in self.means]))


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> Scaler:
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    row = df.agg(
        *[F.avg(x).alias(f"m_{c}") for c, x in filled.items()],
        *[F.stddev_pop(x).alias(f"s_{c}") for c, x in filled.items()],
    ).first()
    return Scaler(
        {c: row[f"m_{c}"] or 0.0 for c in columns},
        {c: row[f"s_{c}"] or 1.0 for c in columns},
    )


def stable_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (or all), the same on every run: smallest hashed ids first.

    A top-n keeps n rows per task, so the table is never sorted as a whole.
    """
    return df.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), id_col).limit(n)


def finite_array(col: str) -> Column:
    return F.transform(col, lambda x: finite(x, VALUE_BOUND))


class Cost(NamedTuple):
    trainingCost: float


@dataclass(frozen=True)
class KMeansClusters:
    """A fit over a column of ML vectors, with the names of Spark's ``KMeansModel``."""

    fit: kmeans.Fit
    features: str

    @property
    def summary(self) -> Cost:
        return Cost(self.fit.cost)

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.fit.centres)

    def transform(self, df: DataFrame) -> DataFrame:
        wide = df.withColumn("__x", vector_to_array(self.features))
        return _assigned(wide, "__x", self.fit, "cluster").drop("__x")


def fit_kmeans(df: DataFrame, k: int, seeds: Sequence[int], features: str = "features") -> KMeansClusters:
    """Best of several starts by within-cluster cost. All starts share one pass over the rows per iteration."""
    fits = kmeans.fit_many(df.select(vector_to_array(features).alias("x")), "x", [k], seeds)
    if not fits:
        raise ValueError("no rows to cluster")
    return KMeansClusters(fits[k], features)


def silhouette_scores(
    df: DataFrame, vector: str, label_cols: Sequence[str], tile_rows: int = TILE_ROWS
) -> DataFrame:
    """Mean Euclidean silhouette per label column, exact over all rows. A cluster of one row scores 0.

    Equal rows count as one with a weight. In more than ``BOX_DIMENSIONS`` dimensions
    the work is quadratic in the rows that differ; what is shuffled is not: see ``_silhouettes``.
    Use ``silhouette_squared`` where the work is too much.
    """
    labels = F.array(*[F.col(c).cast("string") for c in label_cols])
    equal = df.select(F.col(vector).cast("array<double>").alias("x"), labels.alias("labels")).groupBy("x", "labels").agg(
        F.count(F.lit(1)).cast("double").alias("weight")).persist()
    means = _silhouettes(equal, list(label_cols), tile_rows)
    equal.unpersist()
    return means


def _silhouettes(rows: DataFrame, names: Sequence[str], tile_rows: int = TILE_ROWS) -> DataFrame:
    """(labelling, silhouette) of rows (x, labels, weight), found at once; ``rows`` should be persisted.

    Rows are dealt to tiles of bounded size. The tiles, kept by the executors,
    meet in a Cartesian product: a task holds one run of tiles of bounded bytes
    and passes a few others along it, so that only sums leave it, one per row,
    cluster and run. Sums meet by tile and by bucket of clusters.

    In few dimensions tiles are boxes of neighbouring rows. Only near ones meet,
    and sums over far ones go through their nodes (``operators/boxes``), which
    are far fewer than the rows: work grows about as the rows do, and every row
    counts, to about nine places of a silhouette.
    """
    spark = rows.sparkSession
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d"),
                    *[F.countDistinct(F.get("labels", F.lit(i))).alias(f"c{i}") for i in range(len(names))]).first()
    kinds = "labelling string, silhouette double"
    if not size["n"]:
        return spark.createDataFrame([], kinds)
    buckets = math.ceil((1 + max(size[2:])) / BUCKET_CLUSTERS)
    box_rows = min(BOX_ROWS, tile_rows)
    boxed = (size["n"] > 16 * box_rows and 0 < size["d"] <= BOX_DIMENSIONS
             and sum(size[2:]) + len(names) <= BOX_CLUSTERS)
    tiles = min(BOXES, math.ceil(size["n"] / box_rows)) if boxed else math.ceil(size["n"] / tile_rows)
    cores = spark.sparkContext.defaultParallelism
    parts = math.ceil(tiles / min(8, math.ceil(tiles / (4 * cores))))
    runs = min(parts, math.ceil(8 * size["n"] * max(size["d"], 1) / RUN_BYTES))
    # Rows that differ have hashes of their own, so that tiles hold about as many each on every run.
    tile = _box_of(rows, size["n"], tiles) if boxed else F.pmod(F.xxhash64("x", "labels"), F.lit(tiles))
    dealt = rows.withColumn("tile", tile).repartition(parts, "tile")
    packed = dealt.groupBy("tile").applyInPandas(_packed_tile, "tile long, body binary").persist()
    # A tile's own vectors come with the first pair of a task only, if all its pairs are there.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lefts, rights = packed.select(F.col("tile").alias("a"), F.col("body").alias("x")), packed.coalesce(runs).select(
        F.col("tile").alias("b"), F.col("body").alias("y"), first.alias("first")).hint("shuffle_replicate_nl")
    far = _far_tiles(packed) if boxed else None
    if far is None:
        pairs = lefts.crossJoin(rights).select("a", F.when(F.col("first"), F.col("x")).alias("x"), "b", "y")
    else:
        near = spark.createDataFrame([(int(t), [int(b) for b in far.tiles[~apart]]) for t, apart in zip(far.tiles, far.apart)],
                                     "a long, near array<long>")
        pairs = lefts.join(F.broadcast(near), "a").crossJoin(rights).where(F.array_contains("near", F.col("b"))).select(
            "a", "x", "b", "y")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _distance_sums(batches, buckets)

    sums = pairs.mapInArrow(add, "a long, which int, bucket int, body binary")
    if far is not None:
        shared = spark.sparkContext.broadcast(far)

        def add_far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _far_sums(batches, shared.value, buckets)

        sums = sums.unionByName(packed.mapInArrow(add_far, sums.schema))
    per_cluster = sums.groupBy("a", "which", "bucket").applyInPandas(
        _own_and_nearest, "a long, which int, row int, weight double, n double, own double, b double")
    per_row = per_cluster.groupBy("a", "which", "row").agg(
        F.max("weight").alias("weight"), F.max("n").alias("n"), F.max("own").alias("own"), F.min("b").alias("b"))
    a = F.when(F.col("n") > 1, F.col("own") / (F.col("n") - 1))
    s = F.coalesce(F.try_divide(F.col("b") - a, F.greatest(a, F.col("b"))), F.lit(0.0))
    s = F.when(F.col("b").isNotNull(), F.when(F.col("n") > 1, s).otherwise(0.0))
    mean = F.try_divide(F.sum(s * F.col("weight")), F.sum(F.when(s.isNotNull(), F.col("weight"))))
    with batches_of(spark, PAIR_BYTES):
        found = per_row.groupBy("which").agg(mean.alias("silhouette")).collect()
    packed.unpersist()
    return spark.createDataFrame([(names[r["which"]], r["silhouette"]) for r in found], kinds)


def _box_of(rows: DataFrame, n: int, tiles: int) -> Column:
    """The number of the box of a row's vector ``x``. Only the bounds of boxes follow from a sample of bounded size."""
    every = max(1, n // (BOX_SAMPLE * tiles))
    sample = rows.where(F.pmod(F.xxhash64("x", F.lit(1)), F.lit(every)) == 0).select("x").toArrow().column("x")
    splits = boxes.split(np.array(sample.to_pylist(), dtype=float), tiles)

    @F.pandas_udf("long")
    def box(x: pd.Series) -> pd.Series:
        return pd.Series(splits.leaf(np.array(x.tolist(), dtype=float)))

    return box("x")


class _FarTiles(NamedTuple):
    """Boxes as they look from afar: which are apart, and by tile the nodes' axes and the weight of each cluster there."""

    tiles: np.ndarray
    apart: np.ndarray
    axes: list
    weights: list
    sizes: np.ndarray
    clusters: list


def _far_tiles(packed: DataFrame) -> _FarTiles | None:
    """The boxes' nodes with weights, a table of bounded size; None if few boxes are apart."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                x, weights, labels = pickle.loads(body.as_py())
                bounds = x.min(axis=0), x.max(axis=0)
                grid, half, found = [], np.inf, {}
                if np.isfinite(x).all():
                    grid, half = boxes.axes(x)
                    if math.prod(map(len, grid)) > len(x):  # the rows themselves are fewer
                        grid, half = [], np.inf
                if grid:
                    share = boxes.shares(grid, x).T
                    for which, (codes, clusters) in enumerate(labels):
                        for code, cluster in enumerate(clusters):
                            mine = np.where(codes == code, weights, 0.0)
                            found[which, cluster] = mine.sum(), share @ mine
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tile], pa.int64()), pa.array([pickle.dumps((bounds, half, grid, found))], pa.binary())],
                    ["tile", "body"])

    looks = packed.mapInArrow(look, "tile long, body binary").toArrow().sort_by("tile")
    bounds, half, grids, founds = zip(*map(pickle.loads, looks.column("body").to_pylist()))
    apart = boxes.apart(np.array([b[0] for b in bounds]), np.array([b[1] for b in bounds]), np.array(half))
    if 2 * apart.sum() < apart.size:
        return None
    clusters = sorted({c for found in founds for c in found}, key=repr)
    sizes, weights = np.zeros((len(founds), len(clusters))), []
    for i, (grid, found) in enumerate(zip(grids, founds)):
        columns = np.zeros((math.prod(map(len, grid)) if grid else 0, len(clusters)))
        for j, cluster in enumerate(clusters):
            if cluster in found:
                sizes[i, j], columns[:, j] = found[cluster]
        weights.append(columns)
    return _FarTiles(np.array(looks.column("tile").to_pylist()), apart, list(grids), weights, sizes, clusters)


def _far_sums(batches: Iterator[pa.RecordBatch], far: _FarTiles, buckets: int) -> Iterator[pa.RecordBatch]:
    """As ``_distance_sums``, over the tiles that are apart from a tile: from its nodes to theirs."""
    places = [boxes.nodes(grid) if grid else np.empty((0, 0)) for grid in far.axes]
    for batch in batches:
        for a, body in zip(batch.column(0).to_pylist(), batch.column(1)):
            i = int(np.searchsorted(far.tiles, a))
            others = np.flatnonzero(far.apart[i])
            if not len(others):
                continue
            own = pickle.loads(body.as_py())
            y, weights = np.vstack([places[j] for j in others]), np.vstack([far.weights[j] for j in others])
            near = _near_side(places[i])
            sums = sum(_distances(near, _far_side(y[start:start + PIECE_NODES])) @ weights[start:start + PIECE_NODES]
                       for start in range(0, len(y), PIECE_NODES))
            sums, sizes = (boxes.shares(far.axes[i], own[0]) @ sums).T, far.sizes[others].sum(axis=0)
            found = {cluster: (n, total) for cluster, n, total in zip(far.clusters, sizes, sums) if n}
            yield from _sent(a, own, found, buckets)


def _packed_tile(part: pd.DataFrame) -> pd.DataFrame:
    """A tile as bytes: vectors, weights, and for each labelling the labels' numbers and names."""
    x = np.array(part["x"].tolist(), dtype=float)
    coded = [pd.factorize(pd.Series(list(column), dtype=object), use_na_sentinel=False) for column in zip(*part["labels"])]
    labels = [(codes.astype(np.int32), list(names)) for codes, names in coded]
    return pd.DataFrame({"tile": part["tile"].iloc[:1], "body": [pickle.dumps((x, part["weight"].to_numpy(), labels))]})


def _near_side(x: np.ndarray) -> np.ndarray:
    """Rows whose products with ``_far_side`` of others are squared distances."""
    return np.hstack([-2 * x, (x * x).sum(axis=1)[:, None], np.ones((len(x), 1))])


def _far_side(y: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.vstack([y.T, np.ones(len(y)), (y * y).sum(axis=1)]))


def _distances(near: np.ndarray, far: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """Distances between rows as ``_near_side`` and ``_far_side`` give them; memory that is used again costs far less than new."""
    square = np.dot(near, far, out=out)
    return np.sqrt(np.maximum(square, 0.0, out=square), out=square)


def _distance_sums(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Weighted sums of distances from each row of a tile to each cluster of the tiles it meets, for every labelling.

    The pairs of a tile follow each other, and only the first must have its vectors. Sums of more than ``BUCKET_CLUSTERS`` clusters leave before the next pair.
    """
    at, own, near, found, room = None, None, None, {}, np.empty(0)
    for batch in batches:
        for a, b, left, right in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1), batch.column(3)):
            if a != at:
                yield from _sent(at, own, found, buckets)
                at, own, found = a, pickle.loads(left.as_py()), {}
                near = _near_side(own[0])
            x = own[0]
            y, weights, theirs = pickle.loads(right.as_py())
            edges = np.cumsum([0, *(len(clusters) for _, clusters in theirs)])
            onehot = np.zeros((len(y), edges[-1]))
            for start, (codes, _) in zip(edges, theirs):
                onehot[np.arange(len(y)), start + codes] = weights
            sums, far = np.empty((edges[-1], len(x))), _far_side(y)
            if len(room) < PIECE_ROWS * len(y):
                room = np.empty(PIECE_ROWS * len(y))
            for start in range(0, len(x), PIECE_ROWS):
                piece = near[start:start + PIECE_ROWS]
                dist = _distances(piece, far, room[:len(piece) * len(y)].reshape(len(piece), len(y)))
                if a == b:
                    np.fill_diagonal(dist[:, start:], 0.0)
                sums[:, start:start + PIECE_ROWS] = (dist @ onehot).T
            sizes = onehot.sum(axis=0)
            for which, (start, (_, clusters)) in enumerate(zip(edges, theirs)):
                for i, cluster in enumerate(clusters, start):
                    n, total = found.get((which, cluster), (0.0, 0.0))
                    found[which, cluster] = n + sizes[i], total + sums[i]
            if len(found) > BUCKET_CLUSTERS:
                yield from _sent(at, own, found, buckets)
                found = {}
    yield from _sent(at, own, found, buckets)


def _sent(a: int, own: tuple, found: Mapping, buckets: int) -> Iterator[pa.RecordBatch]:
    """The sums of a tile's rows by labelling and bucket of clusters, each with the rows' own labels and weights."""
    if not found:
        return
    dealt: dict[tuple[int, int], list] = {}
    for (which, cluster), (n, total) in found.items():
        bucket = zlib.crc32(repr(cluster).encode()) % buckets
        dealt.setdefault((which, bucket), []).append((cluster, n, total))
    for (which, bucket), sums in dealt.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([a], pa.int64()), pa.array([which], pa.int32()), pa.array([bucket], pa.int32()),
             pa.array([pickle.dumps((own[1], own[2][which], sums))], pa.binary())], ["a", "which", "bucket", "body"])


def _own_and_nearest(parts: pd.DataFrame) -> pd.DataFrame:
    """Of a bucket of clusters, for each row of a tile: its own cluster's size and sum if there, and the least mean of others."""
    totals: dict = {}
    for body in parts["body"]:
        weights, (codes, names), sums = pickle.loads(body)
        for cluster, n, total in sums:
            before = totals.get(cluster, (0.0, 0.0))
            totals[cluster] = before[0] + n, before[1] + total
    n, own, b = (np.full(len(weights), v) for v in (np.nan, np.nan, np.inf))
    numbers = {name: i for i, name in enumerate(names)}
    for cluster, (size, total) in totals.items():
        mine = codes == numbers.get(cluster, -1)
        n[mine], own[mine] = size, total[mine]
        b = np.where(mine, b, np.minimum(b, total / size))
    none = lambda x, missing: pd.Series(x.astype(object)).where(~missing, None)
    return pd.DataFrame({
        "a": parts["a"].iloc[0], "which": parts["which"].iloc[0], "row": np.arange(len(weights)), "weight": weights,
        "n": none(n, np.isnan(n)), "own": none(own, np.isnan(own)), "b": none(b, np.isinf(b))})


def _cluster_sums(df: DataFrame, vector: str, label: str) -> DataFrame:
    """(c, n, s, q) per cluster: rows, sum of vectors and sum of squared norms, combined on the map side."""
    features = array_to_vector(F.col(vector).cast("array<double>"))
    summary = df.select(F.col(label).alias("c"), features.alias("v")).groupBy("c").agg(
        F.count(F.lit(1)).cast("double").alias("n"), Summarizer.metrics("sum", "normL2").summary(F.col("v")).alias("m"))
    squares = F.transform(vector_to_array("m.normL2"), lambda x: x * x)
    return summary.select("c", "n", vector_to_array("m.sum").alias("s"),
                          F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x).alias("q"))


def _blocks(table: DataFrame, order: str, *fields: str) -> list[Column]:
    """The rows of a per-cluster table as arrays of bounded length, each a scalar subquery."""
    n = math.ceil(table.count() / CENTRE_BLOCK)
    if n <= 1:
        return [table.agg(F.collect_list(F.struct(*fields))).scalar()]
    numbered = table.withColumn("__block", F.floor((F.row_number().over(Window.orderBy(order)) - 1) / CENTRE_BLOCK))
    return [numbered.filter(F.col("__block") == i).agg(F.collect_list(F.struct(*fields))).scalar() for i in range(n)]


def silhouette_squared(df: DataFrame, vector: str, label: str) -> DataFrame:
    """Silhouette with squared Euclidean distances over a whole table (one row: silhouette).

    Squared distances split into per-cluster counts, vector sums and norm sums:
    one aggregate and one scan, however large the clusters are. Clusters are
    met in blocks, with a running minimum.
    """
    norm = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    stats = _cluster_sums(df, vector, label)
    rows = df.select(F.col(label).alias("__c"), F.col(vector).alias("__v"), norm.alias("__q"))
    own = stats.toDF("__c", "n_own", "__s", "__sq")
    rows = rows.join(own, rows["__c"].eqNullSafe(own["__c"])).drop(own["__c"])
    product = lambda s: F.aggregate(
        F.zip_with("__v", s, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda acc, x: acc + x)
    # Σ over y in C of |x − y|² = n|x|² − 2 x·Σy + Σ|y|²
    total = lambda n, s, q: n * F.col("__q") - 2 * product(s) + q
    scored = rows.withColumn("own", total(F.col("n_own"), F.col("__s"), F.col("__sq"))).withColumn("b", F.lit(None).cast("double"))
    for block in _blocks(stats, "c", "c", "n", "s", "q"):
        others = F.filter("__block", lambda e: ~e["c"].eqNullSafe(F.col("__c")))
        nearest = F.array_min(F.transform(others, lambda e: total(e["n"], e["s"], e["q"]) / e["n"]))
        scored = scored.withColumn("__block", block).withColumn("b", F.least("b", nearest)).drop("__block")
    a = F.try_divide("own", F.col("n_own") - 1)
    s = F.when(F.col("n_own") > 1, F.coalesce(F.try_divide(F.col("b") - a, F.greatest(a, F.col("b"))), F.lit(0.0)))
    return scored.agg(F.avg(F.coalesce(s, F.lit(0.0))).alias("silhouette"))


def centroids(df: DataFrame, vector: str, label: str) -> DataFrame:
    """Mean vector per label, as (label, centroid)."""
    features = array_to_vector(F.col(vector).cast("array<double>"))
    return df.select(label, features.alias("v")).groupBy(label).agg(
        vector_to_array(Summarizer.mean(F.col("v"))).alias("centroid"))


def nearest_centroid(df: DataFrame, vector: str, centres: DataFrame, label: str, output: str = "nearest") -> DataFrame:
    """Assign each vector to its closest centre (squared Euclidean), ties to the smaller label.

    Centres are met in blocks of bounded length, each carried as a scalar into
    every row's expression, with a running minimum.
    """
    distance = lambda m: F.aggregate(
        F.zip_with(vector, m, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)),
        F.lit(0.0), lambda acc, x: acc + x)
    best = None
    out = df
    for block in _blocks(centres.select(F.col(label).alias("c"), F.col("centroid").alias("m")), "c", "c", "m"):
        ranked = F.transform("__block", lambda e: F.struct(distance(e["m"]).alias("d"), e["c"].alias("c")))
        nearest = F.array_min(ranked)
        out = out.withColumn("__block", block).withColumn(
            "__best", nearest if best is None else F.least("__best", nearest)).drop("__block")
        best = F.col("__best")
    return out.select(*df.columns, F.col("__best.c").alias(output), F.col("__best.d").alias("squared_distance"))


MEASURES = ("euclidean", "squared")


def best_fits(df: DataFrame, vector: str, k_values: Sequence[int] = K_VALUES, restarts: int = RESTARTS, seed: int = 42,
              measure: str = "euclidean") -> tuple[DataFrame, dict[int, kmeans.Fit]]:
    """The scores of each candidate k (see ``choose_k``) and the best fit of each, all found together."""
    if measure not in MEASURES:
        raise ValueError(f"unknown measure {measure!r}; use one of {', '.join(MEASURES)}")
    # Clusters and silhouettes follow from the vector alone, so equal rows are taken once, with their number.
    equal = df.select(F.col(vector).cast("array<double>").alias("x")).where("x is not null").groupBy("x").agg(
        F.count(F.lit(1)).cast("double").alias("weight")).persist()
    fits = kmeans.fit_many(equal, "x", k_values, range(seed, seed + restarts), weight="weight")
    names = [f"k_{k}" for k in fits]
    table = []
    if fits:
        labelled = equal.select("x", "weight", kmeans.labels("x", fits).alias("c")).persist()
        if measure == "euclidean":
            rows = labelled.select("x", "weight", F.transform("c", lambda c: c.cast("string")).alias("labels"))
            found = {r["labelling"]: r["silhouette"] for r in _silhouettes(rows, names).collect()}
        else:
            every = df.select(F.col(vector).cast("array<double>").alias("v")).where("v is not null")
            wide = every.withColumn("c", kmeans.labels("v", fits)).select(
                "v", *[F.get("c", F.lit(i)).alias(name) for i, name in enumerate(names)]).persist()
            found = {name: silhouette_squared(wide, "v", name).first()[0] for name in names}
            wide.unpersist()
        several = labelled.agg(*[
            (F.min(F.get("c", F.lit(i))) != F.max(F.get("c", F.lit(i)))).alias(n) for i, n in enumerate(names)]).first()
        table = [(k, found.get(name) if more else None) for k, name, more in zip(fits, names, several)]
        labelled.unpersist()
    equal.unpersist()
    scores = df.sparkSession.createDataFrame(table, "k int, silhouette_score double")
    return scores.withColumn("silhouette_score", F.round("silhouette_score", 4)).orderBy(
        F.desc_nulls_last("silhouette_score"), "k"), fits


def choose_k(df: DataFrame, vector: str, k_values: Sequence[int] = K_VALUES, restarts: int = RESTARTS, seed: int = 42,
             measure: str = "euclidean") -> DataFrame:
    """Silhouette (rounded to 4 places) for each candidate k, best first, smaller k on ties; null for one cluster.

    Every k is fitted on all rows and scored over all rows. In many dimensions the Euclidean silhouette takes work in
    proportion to the square of the rows, all candidates in one pass over the tiles; ``measure="squared"`` is one scan for each k.
    """
    return best_fits(df, vector, k_values, restarts, seed, measure)[0]


def segment_balance(df: DataFrame, cluster: str, scheme: str | None = None) -> DataFrame:
    """Rows and share per cluster, shares rounded to 4 places."""
    counts = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    out = counts.select(
        *([F.lit(scheme).alias("scheme")] if scheme is not None else []),
        F.col(cluster).alias("cluster"), "n", F.round(F.col("n") / total, 4).alias("share"),
    )
    return out.orderBy("cluster")


def smallest_segment(balance: DataFrame, by: str = "scheme") -> DataFrame:
    """The smallest cluster of each scheme; ties go to the smaller label."""
    first = F.min(F.struct("share", "cluster"))
    return balance.groupBy(by).agg(first.alias("__m")).select(by, "__m.cluster", "__m.share")


def segment_profile(
    df: DataFrame,
    cluster: str,
    period: str = "year",
    means: Mapping[str, tuple[str, int]] | None = None,
    flags: Sequence[str] = (),
    types: Sequence[str] = (),
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Size, share, mean period, chosen means and the dominant flag and type of each cluster.

    ``means`` maps an output name to (column, digits), ``extra`` an output name
    to any further aggregate, taken in the same pass. The first flag listed wins
    a tie.
    """
    means, extra = means or {}, extra or {}
    flags, types = present(df, flags), present(df, types)
    counts = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(period), 2).alias("avg_period"),
        *[F.round(F.avg(c), d).alias(name) for name, (c, d) in means.items()],
        *[F.avg(F.col(c).cast("double")).alias(f"__f_{c}") for c in dict.fromkeys([*flags, *types])],
        *[c.alias(name) for name, c in extra.items()],
    )
    total = counts.agg(F.sum("n")).scalar()
    dominant = []
    if flags:
        dominant.append(first_arg_max({c: F.col(f"__f_{c}") for c in flags}).alias("dominant_flag"))
    if types:
        dominant.append(first_arg_max({c: F.col(f"__f_{c}") for c in types}).alias("dominant_type"))
    return counts.select(
        F.col(cluster).alias("cluster"), "n", F.round(F.col("n") / total, 4).alias("share"),
        "avg_period", *means, *dominant, *extra,
    ).orderBy("cluster")


def _assigned(vectors: DataFrame, vector: str, fit: kmeans.Fit, cluster: str) -> DataFrame:
    return vectors.withColumn(cluster, F.get(kmeans.labels(vector, {fit.k: fit}), F.lit(0)))


def numeric_segmentation(
    train: DataFrame,
    full: DataFrame,
    columns: Sequence[str],
    id_col: str,
    k_values: Sequence[int] = K_VALUES,
    restarts: int = RESTARTS,
    seed: int = 42,
    period: str = "year",
    means: Mapping[str, tuple[str, int]] | None = None,
    flags: Sequence[str] = (),
    types: Sequence[str] = (),
    cluster: str = "numeric_cluster",
    measure: str = "euclidean",
) -> Segmentation:
    """Scale and cluster the training rows, then assign every row with the frozen model."""
    scaler = fit_scaler(train, columns)
    scaled = scaler.transform(train.select(id_col, *columns)).select(id_col, "scaled")
    scores, fits = best_fits(scaled, "scaled", k_values, restarts, seed, measure)
    rows = scores.collect()
    assigned = _assigned(scaler.transform(full), "scaled", fits[rows[0]["k"]], cluster).drop("scaled")
    fit_end = train.agg(F.max(period)).first()[0]
    selection = _selection_table(full, rows, {"fit_end": fit_end})
    return Segmentation(assigned, selection, segment_profile(assigned, cluster, period, means, flags, types))


def _selection_table(df: DataFrame, rows: list, extra: Mapping[str, object]) -> DataFrame:
    table = df.sparkSession.createDataFrame(
        [(r["k"], r["silhouette_score"]) for r in rows], "k int, silhouette_score double")
    return table.withColumns({"selected_k": F.lit(rows[0]["k"]), **{n: F.lit(v) for n, v in extra.items()}})


def text_segmentation(
    train: DataFrame,
    full: DataFrame,
    text_col: str,
    id_col: str,
    grid: Sequence[Mapping[str, int]] = TEXT_GRID,
    k_values: Sequence[int] = K_VALUES,
    restarts: int = RESTARTS,
    seed: int = 42,
    period: str = "year",
    means: Mapping[str, tuple[str, int]] | None = None,
    flags: Sequence[str] = (),
    types: Sequence[str] = (),
    cluster: str = "text_cluster",
    stop_words: Sequence[str] | None = None,
    measure: str = "euclidean",
) -> Segmentation:
    """Try each vector option on the training rows, keep the best silhouette, assign every row.

    The first option wins a tie. Options whose vocabulary has fewer than two
    terms are skipped; if none is left, that is an error.
    """
    # The words are larger than the texts, so they are rebuilt for each pass rather than stored.
    stop = english_stop_words() if stop_words is None else list(stop_words)
    words = add_words(train, text_col, words=WORDS).select(id_col, WORDS)
    floor = min(option["min_df"] for option in grid)
    options = [(option["min_df"], option["max_features"]) for option in grid]
    stats = frequent_statistics(words, options, WORDS, stop, 2).filter(F.col("df") >= floor).persist()
    n_documents = train.count()
    best: tuple[float, dict, TfidfModel, SvdModel, list, kmeans.Fit] | None = None
    tried = []
    models = [tfidf_from_statistics(stats, n_documents, option["min_df"], option["max_features"], WORDS, stop, 2) for option in grid]
    stats.unpersist()
    # The terms of all options are counted in one reading of the texts. Steps in Python that follow each other are stored
    # one by one, since a task that runs them together has a Python process for each.
    every = sorted({term for model in models if model is not None for term in model.vocabulary})
    counted = term_rows(words, every, WORDS, stop, 2).persist()
    counted.count()
    for option, tfidf in zip(grid, models):
        if tfidf is None:
            continue
        size = max(2, min(option["svd_components"], len(tfidf.vocabulary) - 1))
        parts = tfidf.weighted(counted, every).persist()
        parts.count()
        svd = svd_of_parts(parts, size, len(tfidf.vocabulary))
        reduced = _reduce(parts, svd, ("indices", "values")).select("reduced")
        scores, fits = best_fits(reduced, "reduced", k_values, restarts, seed, measure)
        rows = scores.collect()
        parts.unpersist()
        variance = round(svd.explained_variance, 4)
        score = rows[0]["silhouette_score"]
        score = -1.0 if score is None else score
        settings = {
            "min_df": int(option["min_df"]), "max_features": int(option["max_features"]),
            "svd_components": size, "svd_explained_variance": variance,
        }
        tried.append((settings["min_df"], settings["max_features"], size, rows[0]["k"], score, variance))
        if best is None or score > best[0]:
            best = (score, settings, tfidf, svd, rows, fits[rows[0]["k"]])
    counted.unpersist()
    if best is None:
        raise ValueError("no vector option leaves two or more terms")
    _, settings, tfidf, svd, rows, fit = best

    vectors = _reduce(tfidf.transform(add_words(full, text_col, words=WORDS)), svd)
    labelled = _assigned(vectors, "reduced", fit, cluster).drop("reduced", WORDS)
    assigned = labelled.drop("tfidf")
    profile = segment_profile(labelled, cluster, period, means, flags, types, {"__mean": mean_vector()}) \
        .withColumn("top_terms", top_terms(F.col("__mean"), tfidf)).drop("__mean")
    fit_end = train.agg(F.max(period)).first()[0]
    spark = full.sparkSession
    sensitivity = spark.createDataFrame(
        tried, "min_df int, max_features int, svd_components int, selected_k int, "
               "best_silhouette_score double, svd_explained_variance double",
    ).orderBy(F.desc("best_silhouette_score"), F.desc("svd_explained_variance"))
    return Segmentation(assigned, _selection_table(full, rows, {**settings, "fit_end": fit_end}), profile, sensitivity)


def _reduce(vectors: DataFrame, svd: SvdModel, parts: Sequence[str] = ()) -> DataFrame:
    return svd.transform(vectors, parts=parts).withColumn("reduced", finite_array("reduced"))
