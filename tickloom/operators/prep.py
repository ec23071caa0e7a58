"""Feature preparation: missing values, targets, lags, scaling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickloom.functions.distribution import cumulative, long_form, quantiles, value_counts
from tickloom.functions.lookups import attach
from tickloom.functions.scalars import present
from tickloom.functions.series import (
    candle_cell, drop_halo, nearest_known, number_rows, with_halo)
from tickloom.session import materialize

TIME = "window_start_ms"
# Name parts that keep a numeric column from being scaled.
NOT_SCALED = ("timestamp", "window", "_ms", "future_close")
# Name parts that keep a column out of a feature matrix.
TIME_NAMES = ("timestamp", "time", "date")


def missing_ratios(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing share of every column in one pass: one wide row."""
    columns = columns or df.columns
    kinds = dict(df.dtypes)

    def missing(c: str) -> Column:
        bad = F.col(c).isNull()
        return bad | F.isnan(c) if kinds[c] in ("double", "float") else bad

    return df.agg(*[F.avg(F.when(missing(c), 1.0).otherwise(0.0)).alias(c) for c in columns])


def drop_sparse_columns(df: DataFrame, drop_threshold: float = 0.8) -> DataFrame:
    """Drop columns whose missing share is strictly above the threshold (none at >= 1)."""
    if drop_threshold >= 1.0:
        return df
    ratios = missing_ratios(df).first().asDict()
    return df.drop(*[c for c, r in ratios.items() if r is not None and r > drop_threshold])


def blank_sparse(df: DataFrame, drop_threshold: float = 0.8, columns: list[str] | None = None,
                 by: tuple[str, ...] = ("pair",)) -> DataFrame:
    """Columns that a pair lacks (missing share above the threshold there) become 0 for it.

    A constant tells a model nothing, so this is what dropping the column for that pair alone
    means while all pairs share one table; no row of the pair is lost to it.
    """
    kinds = dict(df.dtypes)
    columns = columns or [c for c, k in kinds.items() if k in ("double", "float") and c not in by]
    if drop_threshold >= 1.0 or not columns:
        return df
    ratios = df.groupBy(*by).agg(*[
        F.avg(F.when(present(c).isNull(), 1.0).otherwise(0.0)).alias(f"_lack_{c}") for c in columns])
    marked = attach(df, ratios, list(by), "left")
    return marked.select(*[
        F.when(F.col(f"_lack_{c}") > drop_threshold, F.lit(0.0)).otherwise(F.col(c)).alias(c) if c in columns
        else F.col(c) for c in df.columns])


def fill_missing(df: DataFrame, method: str = "ffill", columns: list[str] | None = None,
                 keys: tuple[str, ...] = ("pair",), order: str = TIME, step_ms: int = 60_000,
                 cell: Column | None = None, time: str | None = None) -> DataFrame:
    """Fill NULLs along each series, in time order; NaN counts as missing, as in `missing_ratios`.

    ffill: last known value, then the next one at the start; bfill: the reverse;
    interpolate: linear in time, flat at both ends; drop: only complete rows.
    """
    kinds = dict(df.dtypes)
    if method == "drop":
        return df.na.drop()
    if columns is None:
        columns = [c for c in df.columns if c not in (*keys, order)
                   and (method != "interpolate" or kinds[c] in ("double", "float"))]
    if not columns:
        return df
    df = df.withColumns({c: present(c) for c in columns if kinds[c] in ("double", "float")})
    cell = candle_cell(step_ms, order) if cell is None else cell
    at = (time or order) if method == "interpolate" else None
    back = nearest_known(df.withColumn("_cell", cell), list(keys), order, cell, columns, at=at)
    both = nearest_known(back, list(keys), order, cell, columns, later=True, at=at)
    filled = {}
    for c in columns:
        before, after = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        if method == "ffill":
            filled[c] = F.coalesce(before, after)
        elif method == "bfill":
            filled[c] = F.coalesce(after, before)
        elif method == "interpolate":
            t0, t1 = F.col(f"_prev_at_{c}"), F.col(f"_next_at_{c}")
            line = before + (after - before) * F.try_divide(
                (F.col(at) - t0).cast("double"), (t1 - t0).cast("double"))
            filled[c] = F.coalesce(F.col(c), line, before, after)
        else:
            raise ValueError(f"unknown method: {method}")
    return both.withColumns(filled).select(*df.columns)


def handle_missing(df: DataFrame, method: str = "ffill", drop_threshold: float = 0.8,
                   **options) -> DataFrame:
    """Drop sparse columns, then fill or drop what is still missing."""
    return fill_missing(drop_sparse_columns(df, drop_threshold), method, **options)


def add_target(df: DataFrame, horizon: int = 5, name: str | None = None,
               keys: tuple[str, ...] = ("pair",), step_ms: int = 60_000,
               by: str = "rows") -> DataFrame:
    """Future close as target; rows without one are dropped.

    by="rows": the close `horizon` rows later. by="time": the close of the candle that
    starts `horizon` steps later, which differs where candles are missing.
    """
    name = name or f"future_close_{horizon}m"
    keys = list(keys)
    if by == "time":
        later = df.select(*keys, (F.col(TIME) - F.lit(horizon * step_ms)).alias(TIME),
                          F.col("close").alias(name)).filter(F.col(name).isNotNull())
        return df.join(later, [*keys, TIME]).select(*df.columns, name)
    numbered = number_rows(df, keys, [TIME], candle_cell(step_ms))
    rows, w = with_halo(numbered, keys, after=horizon)
    return drop_halo(rows.withColumn(name, F.lead("close", horizon).over(w))).filter(
        F.col(name).isNotNull()).select(*df.columns, name)


def add_lags(df: DataFrame, columns: list[str], periods: list[int],
             keys: tuple[str, ...] = ("pair",), step_ms: int = 60_000) -> DataFrame:
    """Columns `<c>_lag_<n>`; unknown columns are skipped, incomplete rows dropped."""
    columns = [c for c in columns if c in df.columns]
    keys = list(keys)
    numbered = number_rows(df, keys, [TIME], candle_cell(step_ms))
    rows, w = with_halo(numbered, keys, before=max(periods, default=0))
    lags = {f"{c}_lag_{n}": F.lag(c, n).over(w) for c in columns for n in periods}
    return drop_halo(rows.withColumns(lags)).select(*df.columns, *lags).na.drop()


def scaled_columns(df: DataFrame) -> list[str]:
    """Numeric columns whose name marks neither time, window nor target."""
    return [c for c, kind in df.dtypes
            if kind in ("double", "bigint") and not any(part in c for part in NOT_SCALED)]


def feature_matrix(df: DataFrame, target: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Numeric columns that are not time-named, with the target last if there is one.

    `keep` names key columns to retain beside the features.
    """
    number = (T.NumericType,)
    features = [f.name for f in df.schema.fields
                if f.name != target and f.name not in keep and isinstance(f.dataType, number)
                and not any(part in f.name.lower() for part in TIME_NAMES)]
    tail = [target] if target in df.columns else []
    return df.select(*keep, *features, *tail)


@dataclass(frozen=True)
class Scaler:
    """Fitted centre and scale per column: one row per key, or a single row without keys."""

    stats: DataFrame
    columns: tuple[str, ...]
    keys: tuple[str, ...] = ()


def fit_scaler(df: DataFrame, columns: list[str] | None = None, kind: str = "standard",
               keys: tuple[str, ...] = ("pair",)) -> Scaler:
    """Fit on `df`. standard: mean and population deviation; robust: median and exact
    interquartile range. A scale of 0 becomes 1."""
    columns = columns or scaled_columns(df)
    if kind == "standard":
        stats = df.groupBy(*keys).agg(*[
            s for c in columns for s in (F.avg(c).alias(f"{c}__center"),
                                         F.stddev_pop(c).alias(f"{c}__scale"))])
    elif kind == "robust":
        counted = cumulative(value_counts(long_form(df, columns, list(keys)), list(keys)),
                             ["n"], list(keys))
        q = quantiles(counted, {"q1": 0.25, "q2": 0.5, "q3": 0.75}, list(keys))
        stats = q.groupBy(*keys).agg(*[
            s for c in columns for s in (
                F.max(F.when(F.col("column") == c, F.col("q2"))).alias(f"{c}__center"),
                F.max(F.when(F.col("column") == c, F.col("q3") - F.col("q1"))).alias(f"{c}__scale"))])
    else:
        raise ValueError(f"unknown scaler: {kind}")
    return Scaler(stats, tuple(columns), tuple(keys))


def apply_scaler(df: DataFrame, scaler: Scaler) -> DataFrame:
    """Scale the fitted columns in place."""
    if scaler.keys:
        joined = attach(df, scaler.stats, list(scaler.keys))
    else:
        # Without keys there is exactly one row of statistics, so it becomes literals.
        row = scaler.stats.first().asDict()
        joined = df.withColumns({k: F.lit(v) for k, v in row.items()})

    def scale(c: str) -> Column:
        width = F.col(f"{c}__scale")
        return (F.col(c) - F.col(f"{c}__center")) / F.when(width == 0, 1.0).otherwise(width)

    return joined.withColumns({c: scale(c) for c in scaler.columns}).select(*df.columns)


def prepare(df: DataFrame, horizon: int = 5, method: str = "interpolate", scale: bool = True,
            step_ms: int = 60_000, kind: str = "standard") -> DataFrame:
    """Clean, add the target, drop non-features and scale; all pairs at once.

    Scaling uses all rows here; to fit on the training rows only, pass scale=False, split,
    and use `fit_scaler` on the training part. The input is stored first: indicator columns
    are long expressions that several steps read.
    """
    clean = handle_missing(materialize(df), method, step_ms=step_ms)
    ready = add_target(clean, horizon, step_ms=step_ms).drop("timestamp", "created_at")
    return apply_scaler(ready, fit_scaler(ready, kind=kind)) if scale else ready
