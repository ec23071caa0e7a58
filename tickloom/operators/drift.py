"""Drift of columns between two periods, and of model errors over time."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickloom.functions.distribution import cumulative, long_form, value_counts
from tickloom.functions.lookups import attach
from tickloom.functions.metrics import (
    mae, mean_error, metrics_from_sums, r2, regression_metrics, rmse)
from tickloom.functions.scalars import present
from tickloom.operators.quality import numeric_columns

# The default decision rules.
LARGE_SAMPLE = 1000
P_VALUE = 0.05
DISTANCE = 0.1
DRIFT_SHARE = 0.5
DAY_MS = 86_400_000
EXACT_ROWS = 10_000         # rows of the larger side up to which a KS probability is counted exactly


def _sides(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values with their counts on both sides; one shuffle for all columns."""
    both = long_form(reference, columns).withColumn("_ref", F.lit(1)).unionByName(
        long_form(current, columns).withColumn("_ref", F.lit(0)))
    return value_counts(both, sums={"n_ref": F.col("_ref"), "n_cur": 1 - F.col("_ref")})


def ks_p_value(statistic: Column, n_ref: Column, n_cur: Column) -> Column:
    """Asymptotic two-sided p-value of the two-sample Kolmogorov-Smirnov statistic."""
    size = n_ref.cast("double") * n_cur / (n_ref + n_cur)
    x = statistic * F.sqrt(size)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0))
        * F.exp(F.lit(-2.0) * k * k * x * x))
    # Below 0.2 the alternating series converges slowly, and the value is 1.
    return F.when(x < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def lattice_exit(apart: int, n: int, m: int) -> float:
    """The share of all orders of n and m different values whose two distribution functions
    differ somewhere by at least apart / (n * m).

    An order is a lattice path from (0, 0) to (n, m). Of the paths to (i, j), i in i + j come
    from (i - 1, j); the share that has left the band goes along the diagonals, and every path
    counts as having left where |i * m - j * n| >= apart. Only positive numbers are added, so
    small shares keep their digits.
    """
    if n > m:
        n, m = m, n
    places = np.arange(n + 1)
    out = np.zeros(n + 2)           # out[i + 1] belongs to i; no path comes from i = -1
    for step in range(1, n + m + 1):
        low, high = max(0, step - m), min(n, step) + 1
        i = places[low:high]
        j = step - i
        share = (out[low:high] * i + out[low + 1:high + 1] * j) / step
        share[np.abs(i * m - j * n) >= apart] = 1.0
        out[low + 1:high + 1] = share
    return float(min(1.0, out[n + 1])) if apart > 0 else 1.0


def exact_ks_p_value(statistic: Column, n_ref: Column, n_cur: Column, rows: int = EXACT_ROWS) -> Column:
    """Two-sided p-value of the two-sample Kolmogorov-Smirnov statistic, from lattice paths;
    null where a side has more than `rows` rows. Ties count as if values were all different."""
    @F.pandas_udf(T.DoubleType())
    def counted(apart: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([lattice_exit(int(d), int(a), int(b)) if 0 < a <= rows and 0 < b <= rows else None
                          for d, a, b in zip(apart, n, m)], dtype="float64")

    known = F.coalesce(statistic, F.lit(0.0))
    return counted(F.round(known * n_ref * n_cur), n_ref, n_cur)


def numeric_drift(reference: DataFrame, current: DataFrame,
                  columns: list[str] | None = None, exclude: tuple[str, ...] = (),
                  exact_rows: int = EXACT_ROWS) -> DataFrame:
    """Per column: KS statistic and p-value, Wasserstein distance over the reference
    deviation, and the verdict (the distance above 1000 reference rows, else the p-value).

    The p-value is exact up to `exact_rows` rows of the larger side and the limit beyond.
    """
    columns = columns or numeric_columns(current, exclude)
    points = cumulative(_sides(reference, current, columns), ["n_ref", "n_cur"])
    f_ref = F.col("cum_n_ref") / F.col("all_n_ref")
    f_cur = F.col("cum_n_cur") / F.col("all_n_cur")
    gap = F.abs(f_ref - f_cur)
    # Distances from the smallest value: no digits are lost where values are large.
    v, n = F.col("value") - F.col("lowest"), F.col("n_ref")
    mean = F.sum(v * n) / F.sum(n)
    both = (F.col("all_n_ref") > 0) & (F.col("all_n_cur") > 0)
    stats = points.filter(both).groupBy("column").agg(
        F.max("all_n_ref").alias("n_reference"),
        F.max("all_n_cur").alias("n_current"),
        F.max(gap).alias("ks_statistic"),
        F.coalesce(F.sum(gap * (F.col("next_value") - F.col("value"))), F.lit(0.0)).alias("wasserstein"),
        (F.sum(v * v * n) / F.sum(n) - mean * mean).alias("_var"))
    deviation = F.sqrt(F.greatest(F.col("_var"), F.lit(0.0)))
    # The deviation is kept away from 0, so a constant reference column still compares.
    scaled = F.col("wasserstein") / F.greatest(deviation, F.lit(0.001))
    tested = F.col("ks_statistic"), F.col("n_reference"), F.col("n_current")
    p_value = ks_p_value(*tested)
    if exact_rows:
        p_value = F.coalesce(exact_ks_p_value(*tested, exact_rows), p_value)
    stats = stats.withColumn("wasserstein_normed", scaled).withColumn("ks_p_value", p_value)
    large = F.col("n_reference") > LARGE_SAMPLE
    compared = stats.select(
        "column", "n_reference", "n_current", "ks_statistic", "ks_p_value", "wasserstein",
        "wasserstein_normed",
        F.when(large, "wasserstein").otherwise("ks").alias("method"),
        F.when(large, F.col("wasserstein_normed") > DISTANCE)
        .otherwise(F.col("ks_p_value") < P_VALUE).alias("drifted"))
    return _with_one_sided(compared, reference, current, columns)


def _with_one_sided(compared: DataFrame, reference: DataFrame, current: DataFrame,
                    columns: list[str]) -> DataFrame:
    """The compared columns and those without a value on a side: drifted if the other has some.

    A column without values on both sides has not drifted. One row per column throughout.
    """
    def known(df: DataFrame, name: str) -> DataFrame:
        kinds = dict(df.dtypes)
        counts = [F.count(present(c) if kinds[c] in ("double", "float") else F.col(c)).alias(f"_{i}")
                  for i, c in enumerate(columns)]
        return df.agg(*counts).select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias(name)) for i, c in enumerate(columns)])))

    counts = known(reference, "n_reference").join(known(current, "n_current"), "column")
    bare = counts.filter("n_reference = 0 OR n_current = 0").select(
        *[F.col(c) if c in ("column", "n_reference", "n_current")
          else F.lit("no values").alias(c) if c == "method"
          else (F.greatest("n_reference", "n_current") > 0).alias(c) if c == "drifted"
          else F.lit(None).cast(kind).alias(c) for c, kind in compared.dtypes])
    return compared.unionByName(bare)


def chi_square_tail(x: float, dof: int) -> float:
    """P(chi-square with `dof` degrees > x), from the finite sum for whole degrees."""
    if dof <= 0 or x <= 0:
        return 1.0
    half = x / 2.0
    if dof % 2 == 0:
        log_term, total = -half, 0.0
        for i in range(dof // 2):
            if i:
                log_term += math.log(half) - math.log(i)
            total += math.exp(log_term)
        return min(1.0, total)
    total = math.erfc(math.sqrt(half))
    log_term = -half + 0.5 * math.log(half) - math.lgamma(1.5)
    for i in range(dof // 2):
        total += math.exp(log_term)
        log_term += math.log(half) - math.log(i + 1.5)
    return min(1.0, total)


@F.pandas_udf(T.DoubleType())
def chi_square_p_value(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi_square_tail(float(x), int(d)) for x, d in zip(statistic, dof)])


def categorical_drift(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: chi-square of the current counts against the reference shares, and the
    Jensen-Shannon distance (base 2); the latter decides above 1000 reference rows.

    A value unseen in the reference makes the chi-square infinite; it then counts with the
    share of half a row.
    """
    def side(df: DataFrame, ref: int) -> DataFrame:
        return df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
            [], columns, "column", "value").filter("value IS NOT NULL").withColumn("_ref", F.lit(ref))

    counts = side(reference, 1).unionByName(side(current, 0)).groupBy("column", "value").agg(
        F.sum("_ref").alias("n_ref"), F.sum(1 - F.col("_ref")).alias("n_cur"))
    totals = counts.groupBy("column").agg(
        F.sum("n_ref").alias("n_reference"), F.sum("n_cur").alias("n_current"),
        F.count(F.lit(1)).alias("categories"))
    # One row per column of the table: bounded by its width.
    joined = counts.join(F.broadcast(totals), "column").filter("n_reference > 0 AND n_current > 0")
    p = F.col("n_ref") / F.col("n_reference")
    q = F.col("n_cur") / F.col("n_current")
    m = (p + q) / 2

    def part(share: Column) -> Column:
        return F.when(share > 0, share * F.log2(share / m)).otherwise(F.lit(0.0))

    expected = F.greatest(F.col("n_ref").cast("double"), F.lit(0.5)) / F.col("n_reference") * F.col("n_current")
    chi = (F.col("n_cur") - expected) * (F.col("n_cur") - expected) / expected
    stats = joined.groupBy("column").agg(
        F.max("n_reference").alias("n_reference"), F.max("n_current").alias("n_current"),
        F.max("categories").alias("categories"),
        F.sum(chi).alias("chi_square"),
        F.sqrt(F.greatest((F.sum(part(p)) + F.sum(part(q))) / 2, F.lit(0.0))).alias("jensen_shannon"))
    stats = stats.withColumn("chi_square_p_value", chi_square_p_value(
        F.col("chi_square"), F.col("categories") - 1))
    large = F.col("n_reference") > LARGE_SAMPLE
    compared = stats.select(
        "column", "n_reference", "n_current", "categories", "chi_square", "chi_square_p_value",
        "jensen_shannon",
        F.when(large, "jensen_shannon").otherwise("chi_square").alias("method"),
        F.when(large, F.col("jensen_shannon") > DISTANCE)
        .otherwise(F.col("chi_square_p_value") < P_VALUE).alias("drifted"))
    return _with_one_sided(compared, reference, current, columns)


def data_drift(reference: DataFrame, current: DataFrame, categorical: tuple[str, ...] = (),
               exclude: tuple[str, ...] = ()) -> DataFrame:
    """One verdict per column: all numeric columns but `exclude` (target, prediction), and
    the categorical ones."""
    numeric = numeric_drift(reference, current, exclude=exclude).select(
        "column", F.lit("num").alias("kind"), "method",
        F.when(F.col("method") == "wasserstein", F.col("wasserstein_normed"))
        .otherwise(F.col("ks_p_value")).alias("score"), "drifted")
    if not categorical:
        return numeric
    return numeric.unionByName(categorical_drift(reference, current, list(categorical)).select(
        "column", F.lit("cat").alias("kind"), "method",
        F.when(F.col("method") == "jensen_shannon", F.col("jensen_shannon"))
        .otherwise(F.col("chi_square_p_value")).alias("score"), "drifted"))


def drift_share(verdicts: DataFrame, named: str = "close") -> DataFrame:
    """Columns, drifted columns, their share, the data-set verdict, and one named column."""
    share = F.count_if("drifted") / F.count(F.lit(1))
    return verdicts.agg(
        F.count(F.lit(1)).alias("columns"),
        F.count_if("drifted").alias("drifted_columns"),
        share.alias("share"),
        (share >= DRIFT_SHARE).alias("dataset_drift"),
        F.coalesce(F.bool_or(F.when(F.col("column") == named, F.col("drifted"))), F.lit(False))
        .alias("named_column_drift"))


def compare_models(predictions: DataFrame, by: tuple[str, ...] = ("pair", "model"),
                   actual: str = "actual", predicted: str = "prediction") -> DataFrame:
    """MAE, RMSE, R2 and mean error of every model on the same actual values."""
    return predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"), mae(actual, predicted).alias("mae"),
        rmse(actual, predicted).alias("rmse"), r2(actual, predicted).alias("r2"),
        mean_error(actual, predicted).alias("mean_error"))


def error_over_time(predictions: DataFrame, window_days: int = 7, step_days: int = 1,
                    actual: str = "actual", predicted: str = "prediction",
                    ms: str = "window_start_ms", by: tuple[str, ...] = ()) -> DataFrame:
    """Errors in hopping windows from the first timestamp on; empty windows have no row.

    Rows are first summed per slot (the greatest common divisor of window and step); only
    those sums are copied into the windows that contain them.
    """
    size, step = window_days * DAY_MS, step_days * DAY_MS
    slot = math.gcd(size, step)
    by = list(by)
    # Actual values are summed as distances from their mean, which keeps the variance exact.
    bounds = predictions.groupBy(*by).agg(
        F.min(ms).alias("_t0"), F.max(ms).alias("_t1"), F.avg(actual).alias("_y0"))
    if by:
        based = attach(predictions, bounds, by, "inner")
    else:
        first = bounds.first()
        based = predictions.withColumns({c: F.lit(first[c]) for c in ("_t0", "_t1", "_y0")})
    error = F.col(actual) - F.col(predicted)
    y = F.when(error.isNotNull(), F.col(actual) - F.col("_y0"))
    slots = based.groupBy(*by, "_t0", "_t1", F.expr(f"(`{ms}` - _t0) div {slot}L").alias("_slot")).agg(
        F.count(error).alias("n"), F.sum(F.abs(error)).alias("sa"), F.sum(error * error).alias("ss"),
        F.sum(y).alias("sy"), F.sum(y * y).alias("syy"))
    per_step, per_size = step // slot, size // slot
    earliest = F.expr(f"greatest((_slot - {per_size} + {per_step}) div {per_step}, 0L)")
    latest = F.least(F.expr(f"_slot div {per_step}"),
                     F.expr(f"(_t1 - _t0 - {size}L) div {step}L"))
    reaches = F.col("_t0") + F.lit(size) <= F.col("_t1")
    spread = slots.filter(reaches).withColumn("_first", earliest).withColumn("_last", latest).filter(
        "_first <= _last").withColumn("_w", F.explode(F.sequence("_first", "_last")))
    summed = spread.groupBy(*by, "_t0", "_w").agg(
        *[F.sum(c).alias(c) for c in ("n", "sa", "ss", "sy", "syy")]).filter("n > 0")
    start = F.col("_t0") + F.col("_w") * F.lit(step)
    return summed.select(
        *by, start.alias("window_start_ms"), (start + F.lit(size)).alias("window_end_ms"),
        *metrics_from_sums("n", "sa", "ss", "sy", "syy"))


def prediction_errors(predictions: DataFrame, candle_rows: DataFrame, horizon_ms: int,
                      bucket_ms: int = DAY_MS, max_mae: float | None = None) -> DataFrame:
    """Predictions against the candle that later closed, per pair and time bucket.

    With `max_mae`, a flag marks the buckets above it.
    """
    actual = candle_rows.select("pair", (F.col("window_start_ms") - F.lit(horizon_ms))
                                .alias("window_start_ms"), F.col("close").alias("_actual"))
    joined = predictions.select("pair", "window_start_ms", "prediction").join(
        actual, ["pair", "window_start_ms"])
    bucket = F.expr(f"(window_start_ms div {bucket_ms}L) * {bucket_ms}L").alias("bucket_ms")
    errors = joined.groupBy("pair", bucket).agg(*regression_metrics("_actual", "prediction"))
    if max_mae is None:
        return errors
    return errors.withColumn("alarm", F.col("mae") > max_mae)
