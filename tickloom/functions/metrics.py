"""Error metrics as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def mae(actual, predicted) -> Column:
    return F.avg(F.abs(_c(actual) - _c(predicted)))


def rmse(actual, predicted) -> Column:
    error = _c(actual) - _c(predicted)
    return F.sqrt(F.avg(error * error))


def mean_error(actual, predicted) -> Column:
    return F.avg(_c(predicted) - _c(actual))


def r2(actual, predicted) -> Column:
    """1 - SSE/SST; NULL when the actual values do not vary."""
    error = _c(actual) - _c(predicted)
    pairs = F.when(error.isNotNull(), _c(actual))
    spread = F.var_pop(pairs) * F.count(pairs)
    return F.lit(1.0) - F.try_divide(F.sum(error * error), spread)


def adjusted_r2(actual, predicted, features: int) -> Column:
    """R2 corrected for the number of features; NULL with too few rows."""
    n = F.count(_c(actual) - _c(predicted))
    return F.lit(1.0) - F.try_divide(
        (F.lit(1.0) - r2(actual, predicted)) * (n - 1), (n - 1 - F.lit(features)).cast("double"))


def regression_metrics(actual, predicted) -> list[Column]:
    """n, mae, rmse and r2 under those names."""
    return [F.count(_c(actual) - _c(predicted)).alias("n_samples"),
            mae(actual, predicted).alias("mae"),
            rmse(actual, predicted).alias("rmse"),
            r2(actual, predicted).alias("r2")]


def metrics_from_sums(n: str, sum_abs: str, sum_sq: str, sum_y: str, sum_yy: str) -> list[Column]:
    """The same metrics from partial sums, for sums combined over several windows.

    `sum_y` and `sum_yy` are of actual values less a constant near them, so that large values
    with little spread lose no digits.
    """
    rows = F.col(n)
    spread = F.col(sum_yy) - F.col(sum_y) * F.col(sum_y) / rows
    return [rows.alias("n_samples"),
            (F.col(sum_abs) / rows).alias("mae"),
            F.sqrt(F.col(sum_sq) / rows).alias("rmse"),
            (F.lit(1.0) - F.try_divide(F.col(sum_sq), F.when(spread != 0, spread))).alias("r2")]
