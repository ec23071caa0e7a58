"""Boosted regression trees of all pairs (and parameter sets) at once.

Rows are binned once by quantiles of their pair. For every level of a tree one aggregation adds
up gradients per (pair, model, node, feature, bin) for all pairs together, so the number of jobs
follows trees and levels, not pairs, and a pair with a third of all rows is spread over tasks
like any other. The few sums of a node meet where its best split is found. Gradients are added
up as whole numbers (2^-24 of the largest residual), so a tree does not depend on the order in
which partial sums come in, nor on an executor that is lost on the way.

A missing value (NULL or NaN) lies below all others. Of equal gains the first feature and the
lowest cut win.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tickloom.functions.lookups import BROADCAST_BYTES, attach
from tickloom.session import discard, materialize, temporary

UNIT = 1 << 24              # steps of the largest residual in which gradients are added up
STEPS = [16, 8, 4, 2, 1]    # a search among 31 cuts
BINS = sum(STEPS) + 1

#: What a parameter set leaves out. `leaves` 0: no limit but the depth.
DEFAULTS = {"trees": 100, "learning_rate": 0.1, "depth": 3, "leaves": 0, "reg_lambda": 0.0, "reg_alpha": 0.0,
            "gamma": 0.0, "min_child_weight": 1, "subsample": 1.0, "colsample": 1.0}

#: The usual starting points of three kinds of boosting.
FAMILIES = {
    "GradientBoosting": {"learning_rate": 0.1, "depth": 3},
    "RegularizedBoosting": {"learning_rate": 0.3, "depth": 6, "reg_lambda": 1.0},
    "LeafwiseBoosting": {"learning_rate": 0.1, "depth": 8, "leaves": 31, "min_child_weight": 20},
}

TREE = T.ArrayType(T.StructType([
    T.StructField("feature", T.ArrayType(T.IntegerType())), T.StructField("threshold", T.ArrayType(T.DoubleType())),
    T.StructField("value", T.ArrayType(T.DoubleType()))]))


def cuts_of(rows: DataFrame, features: list[str], by: tuple[str, ...] = ("pair",)) -> DataFrame:
    """The distinct quantiles of each feature per pair, as `cuts`: one array per feature."""
    at = [i / BINS for i in range(1, BINS)]

    def cuts(name: str) -> Column:
        found = F.array_distinct(F.percentile_approx(_known(name), at, 10_000))
        found = F.coalesce(found, F.array().cast("array<double>"))
        return F.concat(found, F.array_repeat(F.lit(float("inf")), F.lit(BINS - 1) - F.size(found)))

    return rows.groupBy(*by).agg(F.array(*[cuts(c) for c in features]).alias("cuts"))


def _known(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def _bin(value: Column, cuts: Column) -> Column:
    """0 for a missing value, else 1 and the number of cuts below it."""
    below = F.aggregate(F.array(*map(F.lit, STEPS)), F.lit(0),
                        lambda n, s: F.when(value > F.get(cuts, n + s - 1), n + s).otherwise(n))
    return F.when(value.isNull(), F.lit(0)).otherwise(below + 1).cast("byte")


def binned(rows: DataFrame, features: list[str], cuts: DataFrame, by: tuple[str, ...] = ("pair",)) -> DataFrame:
    """The rows with `bins`, one number per feature, by stored cuts."""
    wide = attach(rows, cuts, list(by), "inner", row_bytes=8 * BINS * (len(features) + 1), stored=True)
    return wide.withColumn("bins", F.array(*[_bin(_known(c), F.get("cuts", i)) for i, c in enumerate(features)])).drop("cuts")


def _shrunk(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def _score(g, h, p: dict):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(h + p["reg_lambda"] > 0, _shrunk(g, p["reg_alpha"]) ** 2 / (h + p["reg_lambda"]), 0.0)


def best_split(g: np.ndarray, h: np.ndarray, p: dict, scale: float = 1.0, allowed: np.ndarray | None = None
               ) -> tuple[int, int, float] | None:
    """(feature, last bin to the left, gain) for sums of gradients and rows by feature and bin."""
    total_g, total_h = int(g[0].sum()), int(h[0].sum())
    left_g, left_h = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    right_g, right_h = total_g - left_g, total_h - left_h
    unit = scale / UNIT
    gain = 0.5 * (_score(left_g * unit, left_h, p) + _score(right_g * unit, right_h, p)
                  - _score(np.float64(total_g * unit), np.float64(total_h), p)) - p["gamma"]
    least = max(p["min_child_weight"], 1)
    gain = np.where((left_h >= least) & (right_h >= least), gain, -np.inf)
    if allowed is not None:
        gain[~allowed] = -np.inf
    at = int(gain.argmax())
    if not gain.flat[at] > 0:
        return None
    return at // gain.shape[1], at % gain.shape[1], float(gain.flat[at])


def _node_values(nodes: dict[int, tuple], p: dict, scale: float) -> Iterator[tuple]:
    """(node, feature or None, cut or None, value) of all nodes of a tree.

    `nodes` has (g, h, feature, cut, gain, left g, left h). With `leaves` the splits of the
    highest gain are kept, from the root on; a node below the last kept split has the value of
    the leaf that it lies in.
    """
    for n, (g, h, feature, _, _, gl, hl) in list(nodes.items()):
        if feature is not None:
            nodes.setdefault(2 * n, (gl, hl) + (None,) * 5)
            nodes.setdefault(2 * n + 1, (g - gl, h - hl) + (None,) * 5)
    kept, waiting, leaves = set(), [], 1
    if nodes.get(1, (None,) * 3)[2] is not None:
        waiting.append((-nodes[1][4], 1))
    while waiting and (not p["leaves"] or leaves < p["leaves"]):
        _, n = heapq.heappop(waiting)
        kept.add(n)
        leaves += 1
        for child in (2 * n, 2 * n + 1):
            if nodes[child][2] is not None:
                heapq.heappush(waiting, (-nodes[child][4], child))
    for n in sorted(nodes):
        leaf = n
        for up in range(n.bit_length()):
            if n >> up not in kept:
                leaf = n >> up
        g, h = nodes[leaf][:2]
        over = h + p["reg_lambda"]
        value = -p["learning_rate"] * float(_shrunk(g * scale / UNIT, p["reg_alpha"])) / over if over > 0 else 0.0
        yield n, (nodes[n][2] if n in kept else None), (nodes[n][3] if n in kept else None), value


def _drawn(share: dict[str, float], *what) -> Column:
    """Whether a hash of `what` falls into the share of the row's model."""
    part = F.lit(1.0)
    for name, value in share.items():
        part = F.when(F.col("model") == name, F.lit(float(value))).otherwise(part)
    return F.pmod(F.xxhash64(*what), F.lit(1 << 20)) < part * (1 << 20)


def _columns(name: str, seed: int, tree: int, width: int, share: float) -> np.ndarray | None:
    """The features that a tree of a model may split; one at least."""
    if share >= 1:
        return None
    draw = np.random.default_rng([seed, tree, *name.encode()])
    allowed = np.zeros(width, bool)
    allowed[draw.permutation(width)[:max(1, round(share * width))]] = True
    return allowed


def fit_boosted(train: DataFrame, features: list[str], target: str, models: dict[str, dict] | None = None,
                by: tuple[str, ...] = ("pair",), row_id: tuple[str, ...] = ("window_start_ms",), seed: int = 42) -> DataFrame:
    """One model per pair and parameter set: `by`, model, n, base and trees, as a stored table.

    `models` names parameter sets (see `DEFAULTS`); all of them grow side by side, on one copy
    of the binned rows each. Squared error; second-order gain with L1 and L2 penalties, least
    rows of a child, depth and, with `leaves`, growth by the best leaf. `subsample` draws rows
    by a hash of `row_id`, `colsample` features. Rows without a target are left out. `trees`
    holds, for each tree, feature, threshold and value by node number (1: root; n goes to 2 n
    up to the threshold or if missing, else to 2 n + 1).
    """
    spark = train.sparkSession
    sets = {name: {**DEFAULTS, **p} for name, p in (models or FAMILIES).items()}
    key, width = [*by, "model"], len(features)
    kinds = ", ".join(f"`{c}` {train.schema[c].dataType.simpleString()}" for c in by) + ", model string"
    with temporary(spark):
        known = train.filter(_known(target).isNotNull())
        cuts = materialize(cuts_of(known, features, by))
        y = F.col(target).cast("double")
        # The mean to single precision, which the order of its sums does not reach.
        base = F.avg(y).cast("float").cast("double")
        facts = known.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), base.alias("base"), F.max(y).alias("_y1"), F.min(y).alias("_y0"))
        scale = F.greatest(F.col("_y1") - F.col("base"), F.col("base") - F.col("_y0"))
        facts = materialize(facts.withColumn("scale", F.when(scale > 0, scale).otherwise(1.0)).drop("_y0", "_y1"))
        rows = binned(known.select(*by, *row_id, y.alias("_y"), *[c for c in features if c not in (*by, *row_id)]), features, cuts, by)
        rows = attach(rows.select(*by, *row_id, "_y", "bins"), facts.drop("n"), list(by), "inner", stored=True)
        rows = rows.withColumn("pred", F.col("base")).drop("base").withColumn(
            "model", F.explode(F.array(*[F.lit(name) for name in sets])))
        rows = materialize(rows, keep=True)
        grown, count = [], facts.count() * len(sets)
        for tree in range(max(p["trees"] for p in sets.values())):
            active = {name: p for name, p in sets.items() if p["trees"] > tree}
            with temporary(spark):
                made, rows = _next_tree(rows, active, tree, key, kinds, width, row_id, seed, count)
            grown.append(made)
        discard(rows)
        nodes = grown[0]
        for more in grown[1:]:
            nodes = nodes.union(more)
        model = attach(nodes, facts, list(by), "inner", stored=True)
        model = attach(model, cuts, list(by), "inner", row_bytes=8 * BINS * (width + 1), stored=True)
        at = F.get(F.get("cuts", F.col("feature")), F.col("cut") - 1)
        # Only missing values lie to the left of cut 0.
        threshold = F.when(F.col("cut") == 0, F.lit(float("-inf"))).otherwise(at)
        flat = model.select(*key, "n", "base", "tree", "node", "feature", F.when(F.col("feature").isNotNull(), threshold).alias("threshold"), "value")
        schema = T.StructType([*train.select(*by).schema.fields, T.StructField("model", T.StringType()), T.StructField("n", T.LongType()),
                               T.StructField("base", T.DoubleType()), T.StructField("trees", TREE)])
        result = materialize(flat.groupBy(*key).applyInArrow(_assembled(key), schema), keep=True)
        for made in grown:
            discard(made)
    return result


def _assembled(key: list[str]):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        last: dict[int, int] = {}
        for tree, node in zip(rows["tree"], rows["node"]):
            last[tree] = max(last.get(tree, 1), node)
        trees = {t: {c: [None] * (last[t] + 1) for c in ("feature", "threshold", "value")} for t in sorted(last)}
        for i, tree in enumerate(rows["tree"]):
            for c in trees[tree]:
                trees[tree][c][rows["node"][i]] = rows[c][i]
        kind = pa.list_(pa.struct([("feature", pa.list_(pa.int32())), ("threshold", pa.list_(pa.float64())), ("value", pa.list_(pa.float64()))]))
        first = table.slice(0, 1).select([*key, "n", "base"])
        return first.append_column("trees", pa.array([list(trees.values())], kind))
    return run


def _next_tree(rows, active, tree, key, kinds, width, row_id, seed, models):
    """The nodes of the next tree of every pair and model, and the rows with their new predictions."""
    gradient = F.round((F.col("pred") - F.col("_y")) / F.col("scale") * UNIT).cast("long")
    drawn = _drawn({n: p["subsample"] for n, p in active.items()}, *row_id, "model", F.lit(tree), F.lit(seed))
    drawn_rows = rows.filter(F.col("model").isin(*active)).withColumn("_in", drawn)
    allowed = {name: _columns(name, seed, tree, width, p["colsample"]) for name, p in active.items()}
    levels = []
    for depth in range(max(p["depth"] for p in active.values())):
        now = _placed(drawn_rows.filter("_in"), levels, key, models).filter("node > 0")
        sums = now.select(*key, "scale", "node", gradient.alias("g"), F.posexplode("bins").alias("f", "b")).groupBy(
            *key, "scale", "node", "f", "b").agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("h"))
        levels.append(materialize(sums.groupBy(*key, "scale", "node").applyInArrow(
            _splitter(active, allowed, depth, key, width),
            f"{kinds}, scale double, node int, g long, h long, feature int, cut int, gain double, gl long, hl long")))
    every = levels[0]
    for more in levels[1:]:
        every = every.union(more)
    made = materialize(every.groupBy(*key).applyInArrow(
        _finisher(active, key, tree), f"{kinds}, tree int, node int, feature int, cut int, value double"), keep=True)
    # What a node is worth, by its number; rows of models that have all their trees stay.
    worth = made.groupBy(*key).agg(F.max("node").alias("last"), F.map_from_entries(F.collect_list(F.struct("node", "value"))).alias("m"))
    worth = worth.select(*key, F.transform(F.sequence(F.lit(1), F.col("last")), lambda n: F.col("m")[n]).alias("worth"))
    after = _meet(_placed(rows, levels, key, models), worth, key, models * (16 << len(levels)))
    gain = F.when(F.col("model").isin(*active), F.get("worth", F.abs("node") - 1))
    after = after.withColumn("pred", F.col("pred") + F.coalesce(gain, F.lit(0.0))).select(*rows.columns)
    after = materialize(after, keep=True)
    discard(rows)
    return made, after


def _meet(rows: DataFrame, small: DataFrame, key: list[str], size: int) -> DataFrame:
    """As `attach`, for one row per model whose size is known beforehand."""
    return rows.join(F.broadcast(small) if size <= BROADCAST_BYTES else small.hint("shuffle_merge"), key, "left")


def _placed(rows: DataFrame, levels: list[DataFrame], key: list[str], models: int) -> DataFrame:
    """The rows with their node after the levels so far: negative where no split was found.

    The splits of a model are one value, an array by node number, so this is one join whatever
    the depth.
    """
    if not levels:
        return rows.withColumn("node", F.lit(1))
    every = levels[0]
    for more in levels[1:]:
        every = every.union(more)
    last = (1 << len(levels)) - 1
    split = every.filter("feature IS NOT NULL").groupBy(*key).agg(
        F.map_from_entries(F.collect_list(F.struct("node", F.struct("feature", "cut").alias("s")))).alias("m")).select(
        *key, F.transform(F.sequence(F.lit(1), F.lit(last)), lambda n: F.col("m")[n]).alias("splits"))

    def step(node: Column, _: Column) -> Column:
        split = F.get("splits", node - 1)
        right = (F.get("bins", split["feature"]) > split["cut"]).cast("int")
        return F.when(node < 0, node).when(split.isNull(), -node).otherwise(2 * node + right)

    wide = _meet(rows, split, key, models * (24 << len(levels)))
    return wide.withColumn("node", F.aggregate(F.sequence(F.lit(1), F.lit(len(levels))), F.lit(1), step)).drop("splits")


def _splitter(active, allowed, depth, key, width):
    def run(table: pa.Table) -> pa.Table:
        name = table["model"][0].as_py()
        scale, p = table["scale"][0].as_py(), active[name]
        f, b = (table[c].to_numpy().astype(np.int64) for c in "fb")
        g, h = np.zeros((width, BINS + 1), np.int64), np.zeros((width, BINS + 1), np.int64)
        g[f, b], h[f, b] = table["g"].to_numpy(), table["h"].to_numpy()
        found = best_split(g, h, p, scale, allowed[name]) if depth < p["depth"] else None
        first = table.slice(0, 1).select([*key, "scale", "node"])
        left = (None,) * 5 if found is None else (*found, int(g[found[0], :found[1] + 1].sum()), int(h[found[0], :found[1] + 1].sum()))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64())
        for c, kind, value in zip(("g", "h", "feature", "cut", "gain", "gl", "hl"), kinds, (int(g[0].sum()), int(h[0].sum()), *left)):
            first = first.append_column(c, pa.array([value], kind))
        return first
    return run


def _finisher(active, key, tree):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        nodes = {r["node"]: tuple(r[c] for c in ("g", "h", "feature", "cut", "gain", "gl", "hl")) for r in rows}
        made = list(_node_values(nodes, active[rows[0]["model"]], rows[0]["scale"]))
        same = {c: pa.array([rows[0][c]] * len(made), table.schema.field(c).type) for c in key}
        node, feature, cut, value = zip(*made)
        return pa.table({**same, "tree": pa.array([tree] * len(made), pa.int32()), "node": pa.array(node, pa.int32()),
                         "feature": pa.array(feature, pa.int32()), "cut": pa.array(cut, pa.int32()), "value": pa.array(value, pa.float64())})
    return run


def boosted_value(x: Column, base: Column, trees: Column) -> Column:
    """The prediction of a model's trees for an array of feature values; usable in streams, too."""
    def leaf(tree: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            feature = F.get(tree["feature"], node)
            right = F.coalesce(F.get(x, feature) > F.get(tree["threshold"], node), F.lit(False))
            return F.when(feature.isNull(), node).otherwise(2 * node + right.cast("int"))

        # As many steps as the tree has levels: its arrays hold fewer than 2^levels nodes.
        levels = F.ceil(F.log2(F.size(tree["value"]).cast("double"))).cast("int")
        return F.get(tree["value"], F.aggregate(F.sequence(F.lit(1), F.greatest(levels, F.lit(1))), F.lit(1), step))

    return F.aggregate(trees, base, lambda total, tree: total + leaf(tree))


def predict_boosted(models: DataFrame, df: DataFrame, features: list[str], target: str, by: tuple[str, ...] = ("pair",),
                    row_id: tuple[str, ...] = ("window_start_ms",)) -> DataFrame:
    """Predictions of all models on the rows of their pair: `by`, model, `row_id`, actual, prediction."""
    size = models.agg(F.max(F.aggregate("trees", F.lit(0), lambda n, t: n + F.size(t["value"])))).first()[0] or 0
    listed = models.groupBy(*by).agg(F.collect_list(F.struct("model", "base", "trees")).alias("_models"))
    rows = attach(df, listed, list(by), "inner", row_bytes=32 * (size + 1))
    made = rows.select(*by, *row_id, F.col(target).alias("actual"), F.array(*[_known(c) for c in features]).alias("_x"),
                       F.explode("_models").alias("_m"))
    return made.select(*by, F.col("_m.model").alias("model"), *row_id, "actual",
                       boosted_value(F.col("_x"), F.col("_m.base"), F.col("_m.trees")).alias("prediction"))
