"""Approximate nearest neighbours by low-dimensional stable projections and a kd-tree.

Unit vectors are projected to a few dimensions by a fixed matrix of normal numbers; a squared distance in the
projection is the true one times a chi-square variable with as many degrees of freedom. Rows are dealt to blocks of
bounded size, each indexed once by a kd-tree over its projections; all queries stream past it. The vectors of a block
come up one by one in order of projected distance: leaves open in order of their boxes, and a vector comes up when no
closed leaf can hold a nearer one. Only then is its true cosine worked out, which is what ``verified`` counts. The
search stops when the next squared projected distance, times ``ratio`` squared, exceeds the chi-square quantile of
``confidence`` times the squared true distance of the worst of the best found: a vector that is nearer than that by
``ratio`` would have come up with that probability.

Queries first search one block; the bound that they find there is where their search of all other blocks starts.

On the tables of the tests (64 dimensions, the 5th best cosine near 0.35 to 0.45) neighbours are hardly nearer than
other rows, so the stopping test needs many dimensions to tell them apart; ``README`` has measured figures.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from trendcast.llm.shared import parallelism, written
from trendcast.llm.vectors import doubles, usable

BLOCK_ROWS, QUERY_ROWS = 16_384, 65_536


def chi_square_quantile(probability: float, dims: int) -> float:
    """For an even number of dimensions, by bisection of the closed form."""
    def below(x):
        return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dims // 2))

    low, high = 0.0, 1.0
    while below(high) < probability:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < probability else (low, middle)
    return high


def projection(dim: int, dims: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim, dims]).standard_normal((dim, dims))


class KdTree:
    """Leaves of bounded size over projected points, with the box of each."""

    def __init__(self, points: np.ndarray, leaf: int = 64):
        order, todo, leaves = np.arange(len(points)), [(0, len(points))], []
        while todo:
            a, b = todo.pop()
            part = points[order[a:b]]
            if b - a <= leaf:
                leaves.append((a, b, part.min(axis=0), part.max(axis=0)))
                continue
            axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, axis], middle)]
            todo += [(a, a + middle), (a + middle, b)]
        self.order = order
        self.begin, self.end = (np.array([x[i] for x in leaves]) for i in (0, 1))
        self.low, self.high = (np.stack([x[i] for x in leaves]) for i in (2, 3))

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distances from ``q`` to the boxes."""
        gap = np.maximum(0, np.maximum(self.low - q, q - self.high))
        return np.einsum("ij,ij->i", gap, gap)


class Index:
    """One block: ids, vectors and projections, in the order of the tree's leaves."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, dims: int, seed: int):
        units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        self.matrix = projection(vectors.shape[1], dims, seed)
        points = units @ self.matrix
        self.tree = KdTree(points)
        order = self.tree.order
        self.ids, self.vectors, self.units, self.points = ids[order], vectors[order], units[order], points[order]

    def nearer(self, point: np.ndarray, limit, step: int = 8) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, squared projected distances) in runs of growing distance. ``limit()`` is read before each opening of
        leaves and before each run; what lies beyond it stays closed."""
        far = self.tree.distances(point)
        order = np.argsort(far, kind="stable")
        rows, dist = np.empty(0, np.int64), np.empty(0)
        at = 0
        while True:
            end = min(at + step, len(order))
            open_ = [x for x in order[at:end] if far[x] <= limit()]
            if open_:
                new = np.concatenate([np.arange(self.tree.begin[x], self.tree.end[x]) for x in open_])
                gap = self.points[new] - point
                rows, dist = np.concatenate([rows, new]), np.concatenate([dist, np.einsum("ij,ij->i", gap, gap)])
            closed = far[order[end]] if end < len(order) else np.inf
            ready = dist <= min(closed, limit())
            sort = np.argsort(dist[ready], kind="stable")
            yield rows[ready][sort], dist[ready][sort]
            if end == len(order) or closed > limit():
                return
            rows, dist = rows[~ready], dist[~ready]
            at, step = end, 2 * step

    def search(self, query_id: int, query: np.ndarray, k: int, quantile: float, bound: float | None = None,
               run: int = 64) -> tuple[np.ndarray, np.ndarray, int]:
        """The best ``k`` of the block as (ids, cosines), without the query's own id, and the number of vectors whose
        cosine was worked out. ``bound`` is a cosine that ``k`` vectors elsewhere reach: nothing below it is sought."""
        unit = query / np.linalg.norm(query)
        least = -np.inf if bound is None else bound
        best, seen, cosines, verified = np.empty(0), [], [], 0

        def limit():
            return quantile * max(2 - 2 * least, 1e-12)

        for rows, dist in self.nearer(unit @ self.matrix, limit):
            for at in range(0, len(rows), run):
                if dist[at] > limit():
                    break
                some = rows[at:at + run]
                some = some[self.ids[some] != query_id]
                near = self.units[some] @ unit
                verified += len(some)
                seen.append(some)
                cosines.append(near)
                best = np.concatenate([best, near])
                if len(best) >= k:
                    best = np.partition(best, len(best) - k)[len(best) - k:]
                    least = max(least, best.min())
        if not verified:
            return np.empty(0, np.int64), np.empty(0), 0
        rows, near = np.concatenate(seen), np.concatenate(cosines)
        rows = rows[near >= least - 1e-9]
        # Row by row in one order, so that equal vectors get equal scores.
        found = self.vectors[rows]
        exact = (found * query).sum(axis=1) / (np.sqrt((found * found).sum(axis=1)) * np.sqrt((query * query).sum()))
        top = np.lexsort((self.ids[rows], -exact))[:k]
        return self.ids[rows][top], exact[top], verified


KEY = ("dim", "block", "set")
ANSWER = "dim int, block long, vec_id long, vector array<double>, found array<struct<vec_id:long,score:double>>, verified long"


def _answers(k: int, dims: int, quantile: float, seed: int):
    """Rows sorted by block, set and role to answers: the vectors of a block come first and are kept, its queries follow."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, ids, vectors, index = None, [], [], None
        for rows in batches:
            out = []
            for r in rows.itertuples(index=False):
                if (r.dim, r.block, r.set) != at:
                    at, ids, vectors, index = (r.dim, r.block, r.set), [], [], None
                if r.role == 0:
                    ids.append(r.vec_id)
                    vectors.append(r.vector)
                    continue
                if ids:
                    index = Index(np.array(ids, np.int64), np.stack(vectors), dims, seed)
                    ids, vectors = [], []
                found, scores, verified = (), (), 0
                if index is not None:
                    bound = None if pd.isna(r.bound) else r.bound
                    found, scores, verified = index.search(r.vec_id, np.asarray(r.vector), k, quantile, bound)
                out.append((r.dim, r.block, r.vec_id, r.vector, [
                    {"vec_id": int(i), "score": float(x)} for i, x in zip(found, scores)], verified))
            yield pd.DataFrame(out, columns=["dim", "block", "vec_id", "vector", "found", "verified"])

    return work


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, dims: int = 32, confidence: float = 0.94,
           ratio: float = 1.0, seed: int = 0, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score, verified): the ``k`` nearest found for each query by cosine, ties to smaller ids.

    ``vectors`` and ``queries`` have vec_id and embedding. A query's own id is no candidate for it. Vectors that are
    null, zero or hold null or non-finite components, rows with a null id, and queries of another length than the
    vectors take no part. Repeated ids are candidates one by one; of queries that repeat an id, the smallest vector
    counts. ``verified`` is the number of vectors whose cosine was worked out for the query, in all blocks.

    A query meets every block, so the work is the product of queries and blocks. A block is indexed once for
    ``query_rows`` queries.
    """
    if dims % 2:
        raise ValueError("an even number of dimensions is asked for")
    if ratio < 1:
        raise ValueError("the ratio is 1 or more")
    spark = vectors.sparkSession

    def good(df):
        vector = doubles(df, "embedding")
        return df.where(usable(vector) & F.col("vec_id").isNotNull()).select(
            F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))

    base = good(vectors)
    blocks = max(1, math.ceil(base.count() / block_rows))
    # With the row's number, so that rows which repeat an id are shared out too.
    dealt = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks))
    base = written(base.select(F.size("vector").alias("dim"), dealt.alias("block"), "vec_id", "vector"), "blocks")
    asked = good(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = written(asked.select(
        F.size("vector").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"), "vec_id", "vector",
        F.lit(None).cast("double").alias("bound")), "queries")
    sets = max(1, math.ceil(asked.count() / query_rows))
    tasks = max(parallelism(spark), min(blocks * sets, 64 * parallelism(spark)))
    work = _answers(k, dims, chi_square_quantile(confidence, dims) / ratio ** 2, seed)

    def zero_to(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    def met(some: DataFrame) -> DataFrame:
        stored = base.select("dim", "block", zero_to(sets).alias("set"), F.lit(0).alias("role"), "vec_id", "vector",
                             F.lit(None).cast("double").alias("bound"))
        some = some.select("dim", "block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(sets)).alias("set"),
                           F.lit(1).alias("role"), "vec_id", "vector", "bound")
        both = stored.unionByName(some).repartition(tasks, *KEY).sortWithinPartitions(*KEY, "role")
        return both.mapInPandas(work, ANSWER)

    first = written(met(asked), "first-answers")
    rest = first.select("dim", F.col("block").alias("home"), zero_to(blocks).alias("block"), "vec_id", "vector", F.when(
        F.size("found") == k, F.element_at("found", -1)["score"]).alias("bound")).where("block != home")
    answers = first if blocks == 1 else first.unionByName(met(rest))
    query = Window.partitionBy("query_id")
    found = answers.select(F.col("vec_id").alias("query_id"), "found", F.sum("verified").over(
        Window.partitionBy("vec_id")).alias("verified"))
    found = found.select("query_id", F.inline("found"), "verified")
    order = query.orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score", "verified")
