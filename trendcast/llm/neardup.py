"""Embedding near-dedup by PCA-ordered tiled comparison.

Only vectors of one group are compared. Equal vectors collapse to one class first, which counts its copies. The
classes of a group are dealt to tiles of bounded size by a hash, and each pair of tiles is one task's work, however
large the group. Within a pair of tiles, unit vectors are rotated to the principal axes of the whole table, so the
leading products settle most of a cosine. After a few leading dimensions, the rest of the product is bounded by the
norms of what is left of both vectors, and a pair is dropped once its bound is below the threshold. Pairs that
survive all dimensions are decided by their cosine in double precision on the vectors as given.

A pair of tiles gives at most one count and one link for each of its vectors: no list of pairs is ever made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trendcast.llm.shared import components, written
from trendcast.llm.vectors import doubles, usable

STEPS = (8, 8, 16)  # leading dimensions taken at a time; then all others
SLACK = 1e-9


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes of the unit vectors of each length, as columns, strongest first. Uses all vectors."""
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for v in batch.column(0).to_numpy(zero_copy_only=False):
                x = v / np.linalg.norm(v)
                if len(x) not in sums:
                    sums[len(x)] = np.zeros((len(x), len(x)))
                sums[len(x)] += np.outer(x, x)
        for n, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n * n, n)), pa.array(np.arange(n * n)), pa.array(
                total.ravel())], ["dim", "cell", "value"])

    cells = classes.select("vector").mapInArrow(products, "dim long, cell long, value double")
    summed = cells.groupBy("dim", "cell").agg(F.sum("value").alias("value")).toPandas()  # dim squared rows
    axes = {}
    for n, part in summed.groupby("dim"):
        values, found = np.linalg.eigh(part.sort_values("cell")["value"].to_numpy().reshape(n, n))
        axes[int(n)] = found[:, np.argsort(-values)]
    return axes


def close_pairs(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float, same: bool,
                block: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of x, row of y) with a cosine of at least ``threshold``; each once if x and y are the ``same``."""
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    a, b = (x / nx[:, None]) @ axes, (y / ny[:, None]) @ axes
    ends = [e for e in np.cumsum(STEPS).tolist() if e < a.shape[1]] + [a.shape[1]]
    for k in range(0, len(a), block):
        part, begin = a[k:k + block], ends[0]
        sums = part[:, :begin] @ b[:, :begin].T
        bound = sums + np.outer(np.linalg.norm(part[:, begin:], axis=1), np.linalg.norm(b[:, begin:], axis=1))
        i, j = np.nonzero(bound >= threshold - SLACK)
        if same:
            i, j = i[j > i + k], j[j > i + k]
        sums = sums[i, j]
        for end in ends[1:]:
            if not len(i):
                break
            sums = sums + np.einsum("ij,ij->i", part[i, begin:end], b[j, begin:end])
            bound = sums + np.linalg.norm(part[i, end:], axis=1) * np.linalg.norm(b[j, end:], axis=1)
            on = bound >= threshold - SLACK
            i, j, sums, begin = i[on], j[on], sums[on], end
        if len(i):
            cosine = np.einsum("ij,ij->i", x[i + k], y[j]) / (nx[i + k] * ny[j])
            on = cosine >= threshold
            yield i[on] + k, j[on]


def compare(pair: pd.DataFrame, axes: dict[int, np.ndarray], threshold: float) -> pd.DataFrame:
    """Counts and connecting links of one pair of tiles: rows (id, links, to), ``to`` a linked id or null."""
    def tile(row):
        ids, copies = np.frombuffer(row.ids, np.int64), np.frombuffer(row.copies, np.int64)
        return ids, copies, np.frombuffer(row.vectors, np.float64).reshape(len(ids), -1)

    rows = [tile(r) for r in pair.sort_values("tile").itertuples()]
    same = len(rows) == 1
    (ids, copies, x), (other_ids, other_copies, y) = rows[0], rows[-1]
    counts, others = np.zeros(len(ids), np.int64), np.zeros(len(other_ids), np.int64)
    parent = np.arange(len(ids) + (0 if same else len(other_ids)))
    links = []

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for i, j in close_pairs(x, y, axes[x.shape[1]], threshold, same):
        np.add.at(counts, i, other_copies[j])
        np.add.at(counts if same else others, j, copies[i])
        for s, t in zip(i.tolist(), j.tolist()):
            r, q = root(s), root(t if same else t + len(ids))
            if r != q:
                parent[q] = r
                links.append((ids[s], other_ids[t]))
    known = [(ids, counts)] if same else [(ids, counts), (other_ids, others)]
    out = [pd.DataFrame({"id": n[c > 0], "links": c[c > 0], "to": pd.array([None] * int((c > 0).sum()), "Int64")})
           for n, c in known]
    out.append(pd.DataFrame({"id": [a for a, _ in links], "links": 0, "to": pd.array([b for _, b in links], "Int64")}))
    return pd.concat(out).astype({"id": "int64", "links": "int64", "to": "Int64"})


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, tile_rows: int = 2048, id_col: str = "vec_id",
                    vector_col: str = "embedding", group_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every row: vectors of equal, non-null groups with a cosine of at least
    ``threshold`` are linked; a component is named by its smallest id, and that vector is kept.

    Vectors that are null, zero or hold null or non-finite components, and rows with a null id or group, are linked
    with nothing. Vectors of different lengths are never linked. Rows that repeat an id count one by one as links
    and are one node of a component.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(group_col).alias("group"), doubles(vectors, vector_col).alias("vector"))
    good = usable(F.col("vector")) & F.col("group").isNotNull() & F.col("id").isNotNull()
    linkable = rows.where(good)
    classes = written(linkable.groupBy("group", "vector").agg(
        F.min("id").cast("long").alias("rep"), F.count("*").alias("copies")), "vector-classes")
    axes = principal_axes(classes)
    sizes = classes.groupBy("group", F.size("vector").alias("dim")).agg(F.ceil(F.count("*") / tile_rows).alias("tiles"))
    dealt = classes.withColumn("dim", F.size("vector")).join(sizes, ["group", "dim"]).withColumn(
        "tile", F.pmod(F.xxhash64("rep"), F.col("tiles")))

    def gather(part: pd.DataFrame) -> pd.DataFrame:
        first = part.iloc[0]
        return pd.DataFrame([{
            "group": first["group"], "dim": first["dim"], "tiles": first["tiles"], "tile": first["tile"],
            "ids": part["rep"].to_numpy(np.int64).tobytes(), "copies": part["copies"].to_numpy(np.int64).tobytes(),
            "vectors": np.stack(part["vector"].to_list()).astype(np.float64).tobytes()}])

    group_type = classes.schema["group"].dataType.simpleString()
    tiles = written(dealt.groupBy("group", "dim", "tile").applyInPandas(
        gather, f"group {group_type}, dim int, tiles long, tile long, ids binary, copies binary, vectors binary"), "tiles")
    sent = tiles.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    sent = sent.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))
    compared = written(sent.groupBy("group", "dim", "low", "high").applyInPandas(
        lambda pair: compare(pair, axes, threshold), "id long, links long, to long"), "vector-links")
    counts = compared.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(compared.where("to is not null").select(F.col("id").alias("a"), F.col("to").alias("b")),
                       "vector-components")
    known = classes.join(counts, classes["rep"] == counts["id"], "left").drop("id").join(
        roots, classes["rep"] == roots["node"], "left").select(
            "group", "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"))
    linked = linkable.join(known, ["group", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.col("id").cast("long").eqNullSafe(F.col("component_id")).alias("kept"))
