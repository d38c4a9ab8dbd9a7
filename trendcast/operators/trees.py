"""Regression trees grown level by level, all trees of all parameter sets and windows together.

Features become bin numbers once. A level is one aggregate: the gradient and weight of each (fit, tree, node, feature,
bin), summed where the rows are. Running sums over the bins of a node give every split, and the best of a node is an
arg-max. Rows then move to the children of their nodes. A forest of any number of trees, windows and parameter sets
takes as many levels as its deepest tree. What is shared is grown once: a forest of 100 trees is the first part of one
of 500, and a tree of depth 3 the top of one of depth 8.

A leaf holds G / (H + l2), and a split gains GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2). A forest has
G = weight x target, H = weight and l2 = 0, which is the gain in squared error; boosting has the negative gradients of
the squared error, H = 1 a row, and draws rows and features once for each tree.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window as Over, functions as F

from trendcast.operators.backtest import Params, _clipped, best_parameters, params_json, union_all, window_sizes
from trendcast.operators.metrics import METRICS, metric_columns, summarise_windows
from trendcast.operators.models import BOOSTING, BOOSTING_DEFAULTS, FOREST, FOREST_DEFAULTS, MAX_BINS
from trendcast.operators.splits import Window, window_array, window_rows
from trendcast.session import cut_lineage

# Penalty on the leaves of boosted trees, and the least weight of a child.
LEAF_PENALTY, CHILD_WEIGHT = 1.0, 1.0
# Up to so many rows, a boosted model is grown within the task that holds them; beyond, level by level on the cluster.
ROWS_IN_TASK = 200_000
LEAST_GAIN = 1e-9


def bin_edges(rows: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[list[float]]:
    """Upper edges of the bins of each feature, at most ``max_bins``: its values, or quantiles where it has more."""
    at = [i / (max_bins - 1) for i in range(max_bins)]
    row = rows.agg(*[F.percentile_approx(F.col(f).cast("double"), at, 100 * max_bins).alias(f) for f in features]).first()
    return [sorted(set(row[f] or ())) for f in features]


def bin_codes(features: Sequence[str], edges: Sequence[Sequence[float]]) -> Column:
    """The bins of a row: for each feature the number of edges below its value."""
    def code(name: str, own: Sequence[float]) -> Column:
        value = F.col(name).cast("double")
        return F.size(F.filter(F.lit(list(own)).cast("array<double>"), lambda e: e < value)) if own else F.lit(0)

    return F.array(*[code(f, own) for f, own in zip(features, edges)])


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the texts of ``parts``; the same on every run."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.pmod(F.xxhash64(text), F.lit(1 << 53)) / F.lit(float(1 << 53))


def uniform_of(*parts: object) -> float:
    """``uniform`` of plain values."""
    from xxhash import xxh64_intdigest

    return (xxh64_intdigest(":".join(map(str, parts)), 42) & ((1 << 53) - 1)) / float(1 << 53)


def poisson_one(u: Column) -> Column:
    """A Poisson(1) number from a uniform one: how often a bootstrap takes a row."""
    out, chance, total = F.lit(0), float(np.exp(-1.0)), 0.0
    for k in range(12):
        total += chance
        out = out + (u >= total).cast("int")
        chance /= k + 1
    return out


def grow(samples: DataFrame, by: Sequence[str], depth: int, l2: float = 0.0) -> DataFrame:
    """The nodes of the trees that ``by`` names: (by..., node, feature, bin, g, h, gain), leaves without a feature.

    ``samples`` has, for each row of each tree, ``x`` (bins), ``g``, ``h`` and ``min_h``, the least weight of a child; a
    column ``allowed`` lists the features that a tree may use. The root is node 1 and node k has children 2k, for bins
    up to ``bin``, and 2k + 1. Gains that are equal to six places go to the first feature and its smallest bin. Work and shuffle of a level
    are in proportion to its cells, and no node is gathered in one place.
    """
    limited = "allowed" in samples.columns
    kept = [*by, "x", "g", "h", "min_h", *(["allowed"] if limited else [])]
    state, levels = samples.select(*kept, F.lit(1).alias("node")), []
    key = [*by, "node"]
    for level in range(depth + 1):
        if level == depth:
            none = F.lit(None).cast("int")
            levels.append(state.groupBy(*key).agg(
                none.alias("feature"), none.alias("bin"), F.sum("g").alias("g"), F.sum("h").alias("h"),
                F.lit(None).cast("double").alias("gain")))
            break
        best = cut_lineage(_best_splits(_cells(state, key, limited), key, l2))
        levels.append(best)
        splits = best.where("feature is not null").select(*key, "feature", "bin")
        child = F.col("node") * 2 + (F.get("x", F.col("feature")) > F.col("bin")).cast("int")
        state = cut_lineage(state.join(splits, key).select(*kept, child.alias("node")))
        if state.isEmpty():
            break
    return union_all(levels)


def _cells(state: DataFrame, key: Sequence[str], limited: bool) -> DataFrame:
    cells = state.select(*key, "g", "h", "min_h", *(["allowed"] if limited else []), F.posexplode("x").alias("feature", "bin"))
    if limited:
        cells = cells.where(F.array_contains("allowed", F.col("feature")))
    return cells.groupBy(*key, "feature", "bin").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.max("min_h").alias("min_h"))


def _gain(gl: Column, hl: Column, g: Column, h: Column, l2: float) -> Column:
    return gl * gl / (hl + l2) + (g - gl) * (g - gl) / (h - hl + l2) - g * g / (h + l2)


def _best_splits(cells: DataFrame, key: Sequence[str], l2: float) -> DataFrame:
    node = Over.partitionBy(*key, "feature")
    upto = node.orderBy("bin").rowsBetween(Over.unboundedPreceding, Over.currentRow)
    sums = cells.select(*key, "feature", "bin", "min_h", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
                        F.sum("g").over(node).alias("g"), F.sum("h").over(node).alias("h"))
    allowed = (F.col("hl") >= F.col("min_h")) & (F.col("h") - F.col("hl") >= F.col("min_h")) & (F.col("h") > F.col("hl"))
    gain = F.when(allowed, _gain(F.col("gl"), F.col("hl"), F.col("g"), F.col("h"), l2))
    worth = gain > LEAST_GAIN * F.greatest(F.lit(1.0), F.col("g") * F.col("g") / (F.col("h") + l2))
    split = F.when(worth, F.struct(F.round(gain, 6).alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b")))
    first = F.min(F.struct("feature", "g", "h"))
    return sums.withColumn("split", split).groupBy(*key).agg(F.max("split").alias("s"), first.alias("t")).select(
        *key, (-F.col("s.f")).alias("feature"), (-F.col("s.b")).alias("bin"), F.col("t.g").alias("g"), F.col("t.h").alias("h"),
        F.col("s.gain").alias("gain"))


def compiled(nodes: DataFrame, by: Sequence[str], l2: float = 0.0) -> DataFrame:
    """(by..., nodes): each tree as a map from node to (feature, bin, value), at most 2^(depth + 1) entries."""
    value = (F.col("g") / (F.col("h") + l2)).alias("value")
    return nodes.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("node"), F.struct("feature", "bin", value)))).alias("nodes"))


def walked(nodes: Column, x: Column, depth: int) -> Column:
    """The values on a row's way through a compiled tree after 0, 1, ... ``depth`` splits, by a fold within the row."""
    def step(state: Column, _: Column) -> Column:
        here = nodes[state["node"]]
        below = F.when(here["feature"].isNull(), state["node"]).otherwise(
            state["node"] * 2 + (F.get(x, here["feature"]) > here["bin"]).cast("int"))
        return F.transform(F.array(below), lambda n: F.struct(
            n.alias("node"), F.concat(state["values"], F.array(nodes[n]["value"])).alias("values")))[0]

    start = F.struct(F.lit(1).alias("node"), F.array(nodes[F.lit(1)]["value"]).alias("values"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), start, step)["values"] if depth else start["values"]


def _tagged(rows: DataFrame, features: Sequence[str], windows: Sequence[Window], target: str, keys: Sequence[str],
            period: str) -> DataFrame:
    """Training and held-out rows of each window with their bins and a name for each row."""
    edges = bin_edges(rows, features)
    name = F.concat_ws(":", *[F.col(k).cast("string") for k in (*keys, period)])
    binned = rows.select(*keys, period, F.col(target).cast("double").alias("actual"), name.alias("row"),
                         bin_codes(features, edges).alias("x"))
    return window_rows(binned, windows, period)


def forest_predictions(rows: DataFrame, features: Sequence[str], windows: Sequence[Window], grid: Sequence[Params],
                       target: str = "n", keys: Sequence[str] = (), period: str = "period", seed: int = 42) -> DataFrame:
    """(keys..., hyperparameters, window_id, period, actual, predicted) of every parameter set in every window.

    Each (window, least leaf, tree) is grown once, to the greatest depth; every row goes to a tree as often as a Poisson(1)
    draw says, and the draws of a tree are the same for all fits. With keys, the rows of all series are fitted together.
    """
    full = [FOREST_DEFAULTS | dict(p) for p in grid]
    depth, most = (int(max(p[k] for p in full)) for k in ("max_depth", "n_estimators"))
    leaves = sorted({int(p["min_samples_leaf"]) for p in full})
    tagged = cut_lineage(_tagged(rows, features, windows, target, keys, period))
    by = ["window_id", "min_leaf", "tree"]
    trees = F.explode(F.sequence(F.lit(1), F.lit(most))).alias("tree")
    draws = tagged.where("role = 'train'").select("window_id", "x", "row", F.col("actual").alias("y"), trees)
    draws = draws.withColumn("w", poisson_one(uniform(str(seed), F.col("tree"), F.col("row"))).cast("double")).where("w > 0")
    samples = draws.select("window_id", "tree", "x", (F.col("w") * F.col("y")).alias("g"), F.col("w").alias("h"),
                           F.explode(F.lit(leaves)).alias("min_leaf"))
    samples = samples.withColumn("min_h", F.col("min_leaf").cast("double"))
    model = compiled(grow(samples, by, depth), by)
    held = tagged.where("role = 'validation'").select(*keys, "window_id", period, "actual", "x")
    ways = held.join(model, "window_id").select(
        *keys, "window_id", period, "actual", "min_leaf", "tree", walked(F.col("nodes"), F.col("x"), depth).alias("values"))

    def mean(p: Params) -> Column:
        value = F.when(F.col("tree") <= int(p["n_estimators"]), F.get("values", F.lit(int(p["max_depth"]))))
        return F.struct(F.lit(params_json(given)).alias("hyperparameters"),
                        F.lit(int(p["min_samples_leaf"])).alias("leaf"), F.avg(value).alias("predicted"))

    means = []
    for given, p in zip(grid, full):
        means.append(mean(p))
    scored = ways.groupBy(*keys, "window_id", period, "actual", "min_leaf").agg(F.array(*means).alias("all"))
    return scored.select(*keys, "window_id", period, "actual", "min_leaf", F.inline("all")).where(
        "leaf = min_leaf").drop("leaf", "min_leaf")


def _boosting_fits(grid: Sequence[Params]) -> list[dict]:
    """The fits that a grid needs: parameter sets that differ in rounds only share one, of the most rounds."""
    fits: dict[str, dict] = {}
    for given in grid:
        p = BOOSTING_DEFAULTS | dict(given)
        own = {k: p[k] for k in ("learning_rate", "max_depth", "subsample", "colsample_bytree")}
        fit = fits.setdefault(params_json(own), {**own, "fit": len(fits), "sets": []})
        fit["sets"].append((int(p["n_estimators"]), params_json(given)))
    return list(fits.values())


def _features_drawn(seed: int, round_no: int, n: int, share: float) -> list[int]:
    """The features that a tree may use: the share of them whose numbers of the round are smallest."""
    most = max(1, int(share * n))
    return sorted(range(n), key=lambda f: (uniform_of(seed, round_no, "f", f), f))[:most]


def _best_in_task(x: np.ndarray, g: np.ndarray, node: np.ndarray, n_nodes: int, bins: int, features: np.ndarray):
    """The best split of each node of a level and their sums: feature, bin, G, H, by one histogram of all cells."""
    k = len(features)
    cell = ((node[:, None] * k + np.arange(k)) * bins + x[:, features]).ravel()
    size = n_nodes * k * bins
    gs = np.bincount(cell, np.repeat(g, k), size).reshape(n_nodes, k, bins).cumsum(2)
    hs = np.bincount(cell, minlength=size).reshape(n_nodes, k, bins).cumsum(2).astype(float)
    total_g, total_h = gs[:, 0, -1], hs[:, 0, -1]
    g_all, h_all = total_g[:, None, None], total_h[:, None, None]
    right = h_all - hs
    own = g_all * g_all / (h_all + LEAF_PENALTY)
    gain = gs * gs / (hs + LEAF_PENALTY) + (g_all - gs) ** 2 / (right + LEAF_PENALTY) - own
    gain = gain.round(6)
    gain[(hs < CHILD_WEIGHT) | (right < CHILD_WEIGHT) | (gain <= LEAST_GAIN * np.maximum(1.0, own))] = -np.inf
    flat = gain.reshape(n_nodes, -1)
    best = flat.argmax(1)
    found = np.isfinite(flat[np.arange(n_nodes), best])
    return np.where(found, features[best // bins], -1), best % bins, total_g, total_h


def boosted_rounds(x: np.ndarray, y: np.ndarray, names: Sequence[str], train: np.ndarray, fit: Mapping, seed: int,
                   bins: int) -> Iterator[np.ndarray]:
    """Predictions of all rows after each round of second-order boosting on the rows of ``train``."""
    rate, depth, share = float(fit["learning_rate"]), int(fit["max_depth"]), float(fit["subsample"])
    predicted = np.full(len(y), y[train].mean())
    rounds = max(n for n, _ in fit["sets"])
    for round_no in range(1, rounds + 1):
        features = np.array(_features_drawn(seed, round_no, x.shape[1], float(fit["colsample_bytree"])))
        drawn = train
        if share < 1:
            drawn = train & np.array([uniform_of(seed, round_no, "r", name) < share for name in names])
        node, value = np.zeros(len(y), dtype=np.int64), np.zeros(len(y))
        active = np.ones(len(y), bool)
        residual = y - predicted
        for level in range(depth + 1):
            used = drawn & active
            if not used.any():
                break
            present, index = np.unique(node[used], return_inverse=True)
            feature, cut, g, h = _best_in_task(x[used], residual[used], index, len(present), bins, features)
            if level == depth:
                feature = np.full(len(present), -1)
            # Rows that were not drawn follow the same splits; a node always has drawn rows.
            at = np.searchsorted(present, node)
            at[at == len(present)] = 0
            here = active & (present[at] == node)
            leaf = here & (feature[at] < 0)
            value[leaf] = (g / (h + LEAF_PENALTY))[at[leaf]]
            going = here & ~leaf
            rows = np.flatnonzero(going)
            node[rows] = node[rows] * 2 + (x[rows, feature[at[rows]]] > cut[at[rows]]) + 1
            active = going
        predicted = predicted + rate * value
        yield predicted


def _boosted_in_tasks(tagged: DataFrame, fits: Sequence[Mapping], keys: Sequence[str], period: str, seed: int,
                      bins: int) -> DataFrame:
    """Each (window, fit) in one task, all of them side by side."""
    numbers = F.explode(F.lit([f["fit"] for f in fits])).alias("fit")
    types = {f.name: f.dataType.simpleString() for f in tagged.schema.fields}
    held = ", ".join(f"`{c}` {types[c]}" for c in (*keys, "window_id", period, "actual"))

    def run(group):
        import pandas as pd

        group = group.sort_values("row", kind="stable")
        fit = next(f for f in fits if f["fit"] == group["fit"].iloc[0])
        train = (group["role"] == "train").to_numpy()
        wanted, out = dict.fromkeys(n for n, _ in fit["sets"]), []
        if train.any() and not train.all():
            x = np.array(group["x"].tolist(), dtype=np.int64)
            y = group["actual"].to_numpy(dtype=float)
            for n, p in enumerate(boosted_rounds(x, y, group["row"].tolist(), train, fit, seed, bins), 1):
                if n in wanted:
                    wanted[n] = p[~train]
        rows = group.loc[~train, [*keys, "window_id", period, "actual"]]
        for n, name in fit["sets"]:
            if wanted[n] is not None:
                out.append(rows.assign(hyperparameters=name, predicted=wanted[n]))
        return pd.concat(out) if out else rows.iloc[:0].assign(hyperparameters="", predicted=0.0)

    return tagged.select(*keys, "window_id", period, "actual", "role", "row", "x", numbers).groupBy("window_id", "fit").applyInPandas(
        run, f"{held}, hyperparameters string, predicted double")


def _boosted_by_level(tagged: DataFrame, fits: Sequence[Mapping], keys: Sequence[str], period: str, seed: int,
                      n_features: int) -> DataFrame:
    """All (window, fit) together, each round grown level by level; for rows beyond a task's reach."""
    by = ["window_id", "fit"]
    about = F.array(*[F.struct(
        F.lit(f["fit"]).alias("fit"), F.lit(float(f["learning_rate"])).alias("rate"), F.lit(int(f["max_depth"])).alias("depth"),
        F.lit(float(f["subsample"])).alias("share"), F.lit(max(n for n, _ in f["sets"])).alias("rounds")) for f in fits])
    train = F.col("role") == "train"
    means = tagged.where(train).groupBy("window_id").agg(F.avg("actual").alias("predicted"))
    state = cut_lineage(tagged.join(means, "window_id").select("*", F.inline(about)))
    wanted = {(f["fit"], n): [name for m, name in f["sets"] if m == n] for f in fits for n, _ in f["sets"]}
    out = []
    for round_no in range(1, max(n for _, n in wanted) + 1):
        share = F.col("share")
        drawn = state.where(train & (F.col("rounds") >= round_no)).where(
            (share >= 1) | (uniform(str(seed), str(round_no), "r", F.col("row")) < share))
        columns = F.create_map(*[F.lit(v) for f in fits for v in (f["fit"], _features_drawn(
            seed, round_no, n_features, float(f["colsample_bytree"])))])[F.col("fit")]
        samples = drawn.select(*by, "x", (F.col("actual") - F.col("predicted")).alias("g"), F.lit(1.0).alias("h"),
                               F.lit(CHILD_WEIGHT).alias("min_h"), columns.alias("allowed"), "depth")
        for depth in sorted({int(f["max_depth"]) for f in fits}):
            model = compiled(grow(samples.where(F.col("depth") == depth).drop("depth"), by, depth, LEAF_PENALTY), by,
                             LEAF_PENALTY)
            here = state.where(F.col("depth") == depth).join(model, by, "left")
            value = F.coalesce(F.element_at(walked(F.col("nodes"), F.col("x"), depth), -1), F.lit(0.0))
            moved = here.withColumn("predicted", F.col("predicted") + F.col("rate") * value).drop("nodes")
            state = state.where(F.col("depth") != depth).unionByName(moved.select(*state.columns))
        state = cut_lineage(state)
        for (fit, n), names in wanted.items():
            if n == round_no:
                rows = state.where(~train & (F.col("fit") == fit)).select(*keys, "window_id", period, "actual", "predicted")
                out += [rows.withColumn("hyperparameters", F.lit(name)) for name in names]
    return union_all(out)


def boosted_predictions(rows: DataFrame, features: Sequence[str], windows: Sequence[Window], grid: Sequence[Params],
                        target: str = "n", keys: Sequence[str] = (), period: str = "period", seed: int = 42,
                        rows_in_task: int = ROWS_IN_TASK) -> DataFrame:
    """(keys..., hyperparameters, window_id, period, actual, predicted) of every parameter set in every window.

    Parameter sets that differ in rounds share a fit. Each (window, fit) is grown within a task if a window has at most
    ``rows_in_task`` rows, and level by level over all tasks if it has more; both follow the same rule and draws.
    """
    tagged = cut_lineage(_tagged(rows, features, windows, target, keys, period))
    fits = _boosting_fits(grid)
    largest = tagged.groupBy("window_id").count().agg(F.max("count")).first()[0] or 0
    if largest <= rows_in_task:
        return _boosted_in_tasks(tagged, fits, keys, period, seed, MAX_BINS + 1)
    return _boosted_by_level(tagged, fits, keys, period, seed, len(features))


PREDICTIONS = {FOREST: forest_predictions, BOOSTING: boosted_predictions}


def backtest_grid(name: str, rows: DataFrame, features: Sequence[str], windows: Sequence[Window], grid: Sequence[Params],
                  target: str = "n", keys: Sequence[str] = (), period: str = "period", seed: int = 42,
                  clip: bool = False) -> DataFrame:
    """One row per series, parameter set and window: bounds, row counts and metrics, all fits grown jointly."""
    if name not in PREDICTIONS:
        raise ValueError(f"{name!r} is not a tree model")
    predictions = _clipped(PREDICTIONS[name](rows, features, windows, grid, target, keys, period, seed), clip)
    scores = predictions.groupBy(*keys, "hyperparameters", "window_id").agg(*metric_columns())
    bounds = F.get(window_array(windows), F.col("window_id") - 1)
    return scores.join(window_sizes(rows, windows, keys, period).select(
        *keys, "window_id", "train_start", "n_train", "n_validation"), [*keys, "window_id"]).select(
        *keys, F.lit(name).alias("model"), "window_id", "train_start",
        *[bounds[c].alias(c) for c in ("train_end", "val_start", "val_end")],
        "n_train", "n_validation", "hyperparameters", *METRICS)


def tune_jointly(rows: DataFrame, features: Sequence[str], windows: Sequence[Window], grids: Mapping[str, Sequence[Params]],
                 **options) -> tuple[dict[str, DataFrame], dict[str, dict[str, float]]]:
    """Tuning table and best parameters of each model that has a grid, each grid grown as one."""
    tables = {name: cut_lineage(summarise_windows(backtest_grid(name, rows, features, windows, grid, **options)))
              for name, grid in grids.items()}
    return tables, {name: best_parameters(table) for name, table in tables.items()}


def single_tree(rows: DataFrame, features: Sequence[str], depth: int, target: str = "n", min_leaf: int = 1,
                l2: float = 0.0, centred: bool = False) -> DataFrame:
    """One tree on all rows, without draws: (node, feature, threshold, rows, gain, value).

    ``centred`` takes the mean of the target off first, as the first round of boosting does.
    """
    edges = bin_edges(rows, features)
    y = F.col(target).cast("double")
    if centred:
        y = y - F.lit(rows.agg(F.avg(y)).first()[0])
    samples = rows.select(F.lit(1).alias("fit"), bin_codes(features, edges).alias("x"), y.alias("g"), F.lit(1.0).alias("h"),
                          F.lit(float(min_leaf)).alias("min_h"))
    nodes = grow(samples, ["fit"], depth, l2)
    names = F.lit(list(features))
    threshold = F.get(F.get(F.lit([list(e) for e in edges]), F.col("feature")), F.col("bin"))
    return nodes.select("node", F.get(names, F.col("feature")).alias("feature"), threshold.alias("threshold"),
                        F.col("h").cast("long").alias("rows"), "gain", (F.col("g") / (F.col("h") + l2)).alias("value"))
