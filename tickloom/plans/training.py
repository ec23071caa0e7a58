"""From the feature table to promoted models, all pairs at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions.series import candle_cell
from tickloom.operators.models import (
    baseline_error, best_tuned, leaderboard, predict_all, promotion, read_registry, register, train_families, tune)
from tickloom.operators.prep import (
    add_target, apply_scaler, blank_sparse, drop_sparse_columns, fill_missing, fit_scaler)
from tickloom.operators.selection import training_horizon
from tickloom.operators.splits import split_train_validation_test
from tickloom.schemas import REGISTRY
from tickloom.session import materialize

KEYS = ("pair", "window_start_ms", "window_end_ms", "window_in_sec")


def training_set(table: DataFrame, horizon: int = 5, method: str = "drop", n_splits: int = 5,
                 step_ms: int = 60_000, kind: str = "standard", fit_on: str = "train",
                 drop_threshold: float = 0.8) -> tuple[DataFrame, list[str], str]:
    """Cleaned, scaled rows with target and `split`; also feature names and target name.

    The table is stored first: its columns are long expressions that several steps read. A
    column is left out if it is sparse over all pairs, and made constant for a pair in which
    it is sparse; then `method` fills or drops what is missing. No pair is lost that has a
    complete row left. The scaler sees the training rows only, or everything with fit_on="all". `price` keeps
    the unscaled close for the baseline. The result is stored by pair, since each model
    reads the rows of one.
    """
    known = materialize(table.drop("timestamp", "created_at"))
    wide = drop_sparse_columns(known, drop_threshold)
    clean = materialize(fill_missing(blank_sparse(wide, drop_threshold), method, step_ms=step_ms))
    target = f"future_close_{horizon}m"
    split = split_train_validation_test(
        add_target(clean, horizon, target, step_ms=step_ms), n_splits, step_ms=step_ms)
    split = materialize(split.withColumn("price", F.col("close")))
    features = [c for c, k in split.dtypes
                if k in ("double", "bigint", "int") and c not in (*KEYS, target, "price")]
    seen = split if fit_on == "all" else split.filter("split = 'train'")
    scaled = apply_scaler(split, fit_scaler(seen, features, kind))
    return materialize(scaled, "pair", candle_cell(step_ms)), features, target


def run(table: DataFrame, horizon: int = 5, top_n: int = 1, trials: int = 50,
        families: list[str] | None = None, registry_path: str | None = None,
        model_path: str | None = None, days: int | None = None, as_of_ms: int | None = None,
        step_ms: int = 60_000, n_splits: int = 5, folds: int = 5) -> dict:
    """Compare families, tune the best, decide what to register, and register it.

    `days` before `as_of_ms` limit the rows that are used. Returns the leaderboard, trial
    table, baseline, promotion decisions, the tuned models by pair and family, and the names
    and versions registered (with `registry_path`; models are saved below `model_path`). The
    baseline is registered as well, under the model name `baseline`.
    """
    spark = table.sparkSession
    if days:
        if as_of_ms is None:
            raise ValueError("days need as_of_ms")
        table = training_horizon(table, days, as_of_ms)
    ready, features, target = training_set(table, horizon, n_splits=n_splits, step_ms=step_ms)
    train, test = ready.filter("split = 'train'"), ready.filter("split = 'test'")
    board = materialize(leaderboard(predict_all(
        train_families(train, features, target, families), test, target)))
    order = {}
    for row in board.select("pair", "model", "mae").orderBy("pair", "mae", "model").collect():
        order.setdefault(row["pair"], []).append(row["model"])
    trial_tables, models = [], {}
    for names in sorted({tuple(v[:top_n]) for v in order.values()}):
        pairs = [p for p, v in order.items() if tuple(v[:top_n]) == names]
        mine = F.col("pair").isin(*pairs)
        table_of_trials, tuned = tune(train.filter(mine), test.filter(mine), features, target,
                                  list(names), trials, folds, step_ms=step_ms)
        trial_tables.append(table_of_trials)
        models.update(tuned)
    trials_table = trial_tables[0]
    for more in trial_tables[1:]:
        trials_table = trials_table.unionByName(more)
    baseline = baseline_error(test.withColumn("close", F.col("price")), target)
    chosen = best_tuned(trials_table.filter("chosen").select(
        "pair", "model", "params", F.col("test_mae").alias("mae"))).withColumn(
        "horizon", F.lit(horizon))
    known = read_registry(spark, registry_path) if registry_path else spark.createDataFrame([], REGISTRY)
    decided = materialize(promotion(chosen, known, baseline))
    registered = []
    if registry_path:
        accepted = decided.filter("register").withColumn("feature_columns", F.array(*[F.lit(c) for c in features]))
        persisted = baseline.select("pair", F.lit("baseline").alias("model"), F.lit(horizon).alias("horizon"),
                                    F.col("baseline_mae").alias("mae"))
        registered = register(accepted, registry_path, models, model_path) + register(persisted, registry_path)
    return {"leaderboard": board, "trials": trials_table, "baseline": baseline, "promotion": decided,
            "models": models, "registered": registered}
