"""Time-ordered splits by position in the series; nothing is sorted globally."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.series import candle_cell, number_rows

TIME = "window_start_ms"


def _numbered(df: DataFrame, keys, step_ms: int) -> DataFrame:
    return number_rows(df, list(keys), [TIME], candle_cell(step_ms), total="_n")


def _test_size(n_splits: int, test_size: int | None) -> Column:
    return F.lit(test_size) if test_size else F.expr(f"_n div {n_splits + 1}")


def rolling_folds(df: DataFrame, n_splits: int = 5, test_size: int | None = None,
                  keys: tuple[str, ...] = ("pair",), step_ms: int = 60_000) -> DataFrame:
    """Add `fold`: the one fold (1..n_splits) that tests the row, 0 if it only trains.

    Fold i tests rows [n-(k-i+1)s, n-(k-i)s) and trains on all earlier rows, so a row with
    fold f trains every fold above f.
    """
    numbered = _numbered(df, keys, step_ms).withColumn("_s", _test_size(n_splits, test_size))
    first = F.col("_n") - F.col("_s") * n_splits
    at = F.col("rn") - 1
    fold = F.when(at < first, F.lit(0)).otherwise(
        F.expr(f"(rn - 1 - (_n - _s * {n_splits})) div nullif(_s, 0) + 1"))
    return numbered.withColumn("fold", F.coalesce(fold, F.lit(0)).cast("int")).drop("rn", "_n", "_s")


def split_train_validation_test(df: DataFrame, n_splits: int = 5, test_size: int | None = None,
                                keys: tuple[str, ...] = ("pair",), step_ms: int = 60_000
                                ) -> DataFrame:
    """Add `split`: test is the last fold, validation the one before, train all earlier."""
    if n_splits < 2:
        return split_by_ratio(df, keys=keys, step_ms=step_ms)
    numbered = _numbered(df, keys, step_ms).withColumn("_s", _test_size(n_splits, test_size))
    at = F.col("rn") - 1
    return numbered.withColumn(
        "split",
        F.when(at >= F.col("_n") - F.col("_s"), "test")
        .when(at >= F.col("_n") - 2 * F.col("_s"), "validation")
        .otherwise("train")).drop("rn", "_n", "_s")


def split_by_ratio(df: DataFrame, train: float = 0.7, validation: float = 0.15,
                   keys: tuple[str, ...] = ("pair",), step_ms: int = 60_000) -> DataFrame:
    """Add `split` by shares of the rows, sizes cut to whole rows."""
    numbered = _numbered(df, keys, step_ms)
    n_train = F.floor(F.col("_n") * F.lit(train))
    n_val = F.floor(F.col("_n") * F.lit(validation))
    return numbered.withColumn(
        "split",
        F.when(F.col("rn") <= n_train, "train")
        .when(F.col("rn") <= n_train + n_val, "validation")
        .otherwise("test")).drop("rn", "_n")


def split_by_days(df: DataFrame, as_of_ms: int, train: int = 60, validation: int = 14,
                  test: int = 7) -> DataFrame:
    """Add `split` by days before `as_of_ms`; older and newer rows are dropped."""
    day = 86_400_000
    t0 = as_of_ms - test * day
    v0 = t0 - validation * day
    s0 = v0 - train * day
    ms = F.col(TIME)
    return df.filter((ms >= s0) & (ms < as_of_ms)).withColumn(
        "split", F.when(ms >= t0, "test").when(ms >= v0, "validation").otherwise("train"))
