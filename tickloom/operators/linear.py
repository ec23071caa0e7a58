"""Linear families of all pairs, searched over parameter sets and folds in a fixed number of jobs.

Sums of products per (pair, fold) are all that least squares, ridge, lasso and elastic net need:
every fold's training sums are the total less its own. Tasks add up products of their rows,
Spark adds up the single entries, so no task holds more than the sums of one pair. Errors of
all parameter sets are measured in blocks of rows, to which a pair's coefficients are copied;
a pair with a third of all rows has a third of the blocks.

The objective is (1/2n) |y - Xb|^2 + alpha (l1 |b|_1 + (1 - l1)/2 |b|^2), the intercept free of
penalty. Rows with an unknown value are left out.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.functions.lookups import attach
from tickloom.operators.models import SEED, contiguous_folds, search_space
from tickloom.session import materialize

FAMILIES = ("LinearRegression", "Ridge", "Lasso", "ElasticNet")
BLOCK = 8192                # rows whose errors one task measures at a time
SWEEPS = 1000               # of coordinate descent, at most
SETTLED = 1e-6
WHOLE = -1                  # the fold number of models of all training rows

COEFFICIENTS = "trial int, fold int, intercept double, coefficients array<double>"


def normalized(name: str, params: dict) -> tuple[float, float, bool]:
    """(alpha, l1 share, intercept) of a family's parameters."""
    alpha = float(params.get("regParam", 0.0 if name == "LinearRegression" else 1.0))
    share = {"Lasso": 1.0, "ElasticNet": float(params.get("elasticNetParam", 0.5))}.get(name, 0.0)
    return alpha, share, bool(params.get("fitIntercept", True))


def fold_sums(rows: DataFrame, names: list[str], base: DataFrame) -> DataFrame:
    """pair, fold, i, j and the sum of products of names i and j, from the pair's means on.

    Entry (size, size) is the number of rows, entry (i, size) the sum of name i.
    """
    size = len(names)
    wide = attach(rows.select("pair", "fold", *names), base, ["pair"], "inner", row_bytes=16 * (size + 2))

    def add_up(batches):
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            values = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
            pairs, codes = np.unique(np.array(batch.column("pair").to_pylist(), dtype=object).astype(str), return_inverse=True)
            key = codes * (1 << 20) + batch.column("fold").to_numpy()
            for k in np.unique(key):
                at = np.flatnonzero(key == k)
                own = np.column_stack([values[at] - np.array(batch.column("base")[int(at[0])].as_py()), np.ones(len(at))])
                name = (str(pairs[k >> 20]), int(k & ((1 << 20) - 1)))
                sums[name] = sums.get(name, 0.0) + own.T @ own
        i, j = np.triu_indices(size + 1)
        for (pair, fold), found in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(pair), len(i)), pa.repeat(pa.scalar(fold, pa.int32()), len(i)), pa.array(i, pa.int32()),
                 pa.array(j, pa.int32()), pa.array(found[i, j])], ["pair", "fold", "i", "j", "v"])

    added = wide.mapInArrow(add_up, "pair string, fold int, i int, j int, v double")
    return added.groupBy("pair", "fold", "i", "j").agg(F.sum("v").alias("v"))


def _descend(gram: np.ndarray, cross: np.ndarray, alpha: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Coordinate descent of all parameter sets side by side; one column of coefficients each.

    A set is done when no coefficient moves its part of the gradient by more than `SETTLED` of
    the largest correlation.
    """
    beta, still = np.zeros((len(cross), len(alpha))), np.arange(len(alpha))
    least = SETTLED * max(float(np.abs(cross).max()), 1e-300)
    used = np.flatnonzero(np.diag(gram) > 0)
    for _ in range(SWEEPS):
        now, moved = beta[:, still], np.zeros(len(still))
        limit, ridge = (alpha * share)[still], (alpha * (1 - share))[still]
        slope = cross[:, None] - gram @ now
        for k in used:
            rest = slope[k] + gram[k, k] * now[k]
            step = np.sign(rest) * np.maximum(np.abs(rest) - limit, 0) / (gram[k, k] + ridge) - now[k]
            now[k] += step
            slope -= gram[:, k, None] * step
            moved = np.maximum(moved, np.abs(gram[k, k] * step))
        beta[:, still] = now
        still = still[moved > least]
        if not len(still):
            break
    return beta


def solve(sums: np.ndarray, base: np.ndarray, sets: list[tuple[float, float, bool]]) -> list[tuple[float, np.ndarray]]:
    """(intercept, coefficients) of every parameter set for sums around `base`."""
    n, first, second = sums[-1, -1], sums[:-1, -1], sums[:-1, :-1]
    mean = first / n
    centred = second / n - np.outer(mean, mean)
    whole = second / n + np.outer(mean, base) + np.outer(base, mean) + np.outer(base, base)
    found: list = [None] * len(sets)
    for intercept in (True, False):
        gram = centred if intercept else whole
        mine = [i for i, s in enumerate(sets) if s[2] is intercept]
        lasso = [i for i in mine if sets[i][0] * sets[i][1] > 0]
        betas = {}
        if lasso:
            made = _descend(gram[:-1, :-1], gram[:-1, -1], np.array([sets[i][0] for i in lasso]), np.array([sets[i][1] for i in lasso]))
            betas = dict(zip(lasso, made.T))
        for i in mine:
            beta = betas.get(i)
            if beta is None:
                left = gram[:-1, :-1] + sets[i][0] * np.eye(len(gram) - 1)
                beta = np.linalg.lstsq(left, gram[:-1, -1], rcond=None)[0]
            centre = mean + base
            found[i] = (float(centre[-1] - centre[:-1] @ beta) if intercept else 0.0), beta
    return found


def fit_sets(sums: DataFrame, base: DataFrame, size: int, sets: list[tuple[float, float, bool]], folds: int) -> DataFrame:
    """pair, trial, fold, intercept, coefficients: fitted without the fold, or on everything (`WHOLE`)."""
    def run(table: pa.Table) -> pa.Table:
        fold, i, j, v = (table[c].to_numpy() for c in ("fold", "i", "j", "v"))
        parts = np.zeros((folds, size + 1, size + 1))
        parts[fold, i, j] = v
        parts[fold, j, i] = v
        whole, centre = parts.sum(axis=0), np.array(table["base"][0].as_py())
        rows = []
        for left_out in [WHOLE, *range(folds)]:
            own = whole if left_out == WHOLE else whole - parts[left_out]
            if own[-1, -1] < 1:
                continue
            rows += [(trial, left_out, a, b.tolist()) for trial, (a, b) in enumerate(solve(own, centre, sets))]
        trial, left, a, b = zip(*rows)
        return pa.table({"pair": pa.repeat(table["pair"][0], len(rows)), "trial": pa.array(trial, pa.int32()), "fold": pa.array(left, pa.int32()),
                         "intercept": pa.array(a, pa.float64()), "coefficients": pa.array(b, pa.list_(pa.float64()))})

    wide = attach(sums, base, ["pair"], "inner", row_bytes=16 * (size + 2))
    # Few rows but much work for each pair: the partitions are not to be put together.
    parts = int(sums.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wide.repartition(parts, "pair").groupBy("pair").applyInArrow(run, f"pair string, {COEFFICIENTS}")


def set_errors(rows: DataFrame, fitted: DataFrame, features: list[str], target: str) -> DataFrame:
    """pair, trial, n and the sum of absolute errors of all sets; rows and models meet by (pair, fold)."""
    counted = rows.groupBy("pair", "fold").agg((F.floor(F.count(F.lit(1)) / BLOCK) + 1).alias("blocks"))
    key = ["pair", "fold", "block"]
    dealt = attach(rows, counted, ["pair", "fold"], "inner").select(
        "pair", "fold", F.pmod(F.xxhash64("window_start_ms"), "blocks").alias("block"), *features, F.col(target).alias("_y"))
    copied = attach(fitted, counted, ["pair", "fold"], "inner").select(
        "pair", "fold", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "trial", "intercept", "coefficients")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"pair": pa.array([], pa.string()), "trial": pa.array([], pa.int32()), "n": pa.array([], pa.int64()), "s": pa.array([], pa.float64())})
        x = np.column_stack([left[c].to_numpy() for c in features])
        b = np.array(right["coefficients"].to_pylist())
        off = np.abs(x @ b.T + right["intercept"].to_numpy() - left["_y"].to_numpy()[:, None])
        return pa.table({"pair": pa.repeat(left["pair"][0], len(b)), "trial": right["trial"],
                         "n": pa.array(np.full(len(b), len(x)), pa.int64()), "s": pa.array(off.sum(axis=0))})

    made = dealt.groupBy(*key).cogroup(copied.groupBy(*key)).applyInArrow(run, "pair string, trial int, n long, s double")
    return made.groupBy("pair", "trial").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def _complete(df: DataFrame, features: list[str], target: str, *more: str) -> DataFrame:
    return df.select("pair", "window_start_ms", *more, *[F.col(c).cast("double").alias(c) for c in [*features, target]]).na.drop(
        subset=["pair", *features, target])


def tune_linear(train: DataFrame, test: DataFrame, features: list[str], target: str, names: tuple[str, ...] = FAMILIES,
                trials: int = 50, folds: int = 5, seed: int = SEED, step_ms: int = 60_000) -> tuple[DataFrame, DataFrame]:
    """Seeded random search of the linear families for every pair, by mean MAE over contiguous folds.

    Returns the trials (pair, model, trial, params, cv_mae, test_mae, chosen) and the chosen
    models, fitted on all training rows (pair, model, intercept, coefficients). All pairs try
    the same parameters, `trials` of each family; the number of jobs depends on nothing.
    """
    spark = train.sparkSession
    drawn = []
    for name in names:
        draw = random.Random(f"{seed}:{name}")
        drawn += [(name, n, search_space(name, draw)) for n in range(trials)]
    sets = [normalized(name, params) for name, _, params in drawn]
    known = materialize(contiguous_folds(_complete(train, features, target), folds, step_ms=step_ms))
    columns = [*features, target]
    base = materialize(known.groupBy("pair").agg(F.array(*[F.avg(c) for c in columns]).alias("base")))
    fitted = materialize(fit_sets(fold_sums(known, columns, base), base, len(columns), sets, folds))
    by_fold = set_errors(known, fitted, features, target).select("pair", "trial", (F.col("s") / F.col("n")).alias("cv_mae"))
    held = _complete(test, features, target).withColumn("fold", F.lit(WHOLE))
    on_test = set_errors(held, fitted, features, target).select("pair", "trial", (F.col("s") / F.col("n")).alias("test_mae"))
    # One row per parameter set of the search.
    listed = spark.createDataFrame([(i, name, n, str(sorted(p.items()))) for i, (name, n, p) in enumerate(drawn)],
                                   "number int, model string, trial int, params string")
    board = by_fold.join(on_test, ["pair", "trial"], "left").withColumnRenamed("trial", "number").join(F.broadcast(listed), "number")
    first = F.min(F.struct("cv_mae", "trial")).alias("best")
    board = materialize(board)
    best = board.groupBy("pair", "model").agg(first).select("pair", "model", F.col("best.trial").alias("_best"))
    made = attach(board, best, ["pair", "model"]).withColumn("chosen", F.col("trial") == F.col("_best"))
    made = materialize(made.select("pair", "model", "trial", "params", "cv_mae", F.when(F.col("chosen"), F.col("test_mae")).alias("test_mae"),
                                   "chosen", "number"))
    models = fitted.filter(F.col("fold") == WHOLE).withColumnRenamed("trial", "number").join(
        made.filter("chosen").select("pair", "number", "model"), ["pair", "number"]).select("pair", "model", "intercept", "coefficients")
    return made.drop("number"), models


def fit_families(train: DataFrame, features: list[str], target: str, names: tuple[str, ...] = FAMILIES) -> DataFrame:
    """The families with their default parameters: pair, model, intercept, coefficients."""
    known = materialize(_complete(train, features, target).withColumn("fold", F.lit(0)))
    columns = [*features, target]
    base = materialize(known.groupBy("pair").agg(F.array(*[F.avg(c) for c in columns]).alias("base")))
    sets = [normalized(name, {}) for name in names]
    made = fit_sets(fold_sums(known, columns, base), base, len(columns), sets, 1).filter(F.col("fold") == WHOLE)
    return made.select("pair", F.get(F.array(*map(F.lit, names)), F.col("trial")).alias("model"), "intercept", "coefficients")
