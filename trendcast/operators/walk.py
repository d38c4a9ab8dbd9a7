"""Fitted tree ensembles as arrays, walked inside an expression.

A prediction then needs no model transform: it can stand in a fold, a filter or a streaming query. The arrays are as
large as the model, whatever the table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from trendcast.operators.models import TreeModel

COLUMN = "__trees"
KIND = "array<struct<weight:double,nodes:array<struct<feature:int,threshold:double,right:int,value:double>>>>"
# The lines in which Spark describes a model.
TREE = re.compile(r"Tree \d+ \(weight ([^)]+)\):")
BRANCH = re.compile(r"(If|Else) \(feature (\d+) (<=|>) ([^)]+)\)")
LEAF = re.compile(r"Predict: (.+)")


class Ensemble(NamedTuple):
    """Trees as (weight, nodes). Nodes lie in the order of a walk that goes left first: the left child of node i is
    i + 1, the right one is given. A leaf has no feature."""

    trees: list[tuple[float, list[tuple[int | None, float | None, int | None, float | None]]]]
    depth: int
    divisor: float


def compile_trees(fitted: TreeModel) -> Ensemble:
    """The description of the model, read into arrays. Its numbers are written in full, so nothing is rounded."""
    trees, depth = [], 0
    nodes: list = []
    opened: dict[int, int] = {}  # indent → the last branch begun at it
    for line in fitted.model.toDebugString.splitlines()[1:]:
        text, indent = line.strip(), len(line) - len(line.lstrip())
        if found := TREE.fullmatch(text):
            nodes, opened = [], {}
            trees.append((float(found[1]), nodes))
        elif found := LEAF.fullmatch(text):
            nodes.append((None, None, None, float(found[1])))
            depth = max(depth, sum(at < indent for at in opened))
        elif found := BRANCH.fullmatch(text):
            if found[1] == "If":
                opened = {i: n for i, n in opened.items() if i < indent} | {indent: len(nodes)}
                nodes.append((int(found[2]), float(found[4]), None, None))
            else:
                feature, threshold, _, _ = nodes[opened[indent]]
                nodes[opened[indent]] = (feature, threshold, len(nodes), None)
        elif text:
            raise ValueError(f"unexpected line in the description of a tree: {text!r}")
    forest = isinstance(fitted.model, RandomForestRegressionModel)
    return Ensemble(trees, depth, float(len(trees)) if forest else 1.0)


def with_trees(df: DataFrame, ensemble: Ensemble) -> DataFrame:
    """``df`` with the ensemble in the column ``__trees``: one constant for all rows."""
    one = df.sparkSession.createDataFrame([(ensemble.trees,)], f"trees {KIND}")
    return df.withColumn(COLUMN, one.select("trees").scalar())


def tree_predictor(ensemble: Ensemble, features: Sequence[str]) -> Callable[[Mapping[str, Column]], Column]:
    """From columns of features to the predicted column, for rows of ``with_trees``.

    A value at a threshold goes left. A null in a feature gives a null, where ``transform`` would stop. A feature that
    the mapping lacks is taken from the row. Trees are added up in their order, as ``transform`` does.
    """
    def leaf(nodes: Column, x: Column) -> Column:
        def down(at: Column, _: Column) -> Column:
            node = F.get(nodes, at)
            return F.when(node["feature"].isNull(), at).when(
                F.get(x, node["feature"]) <= node["threshold"], at + 1).otherwise(node["right"])

        if not ensemble.depth:
            return F.get(nodes, F.lit(0))["value"]
        levels = F.array(*[F.lit(i) for i in range(ensemble.depth)])
        return F.get(nodes, F.aggregate(levels, F.lit(0), down))["value"]

    def predict(values: Mapping[str, Column]) -> Column:
        x = F.array(*[(values[f] if f in values else F.col(f)).cast("double") for f in features])
        total = F.aggregate(COLUMN, F.lit(0.0), lambda sum_, tree: sum_ + tree["weight"] * leaf(tree["nodes"], x))
        return F.when(~F.exists(x, lambda v: v.isNull()), total / ensemble.divisor)

    return predict
