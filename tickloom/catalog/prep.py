"""Feature preparation and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog.base import *  # noqa: F403
from tickloom.catalog.base import query, r
from tickloom.operators import prep as P, splits as L
from tickloom.operators.models import contiguous_folds as contiguous

STEP = HOUR * 1000
ORDER = "PARTITION BY pair ORDER BY window_start_ms"
KEPT = "pair, window_start_ms"
COLUMNS = FEATURE_COLUMNS


@query(f"""WITH {FEATURES} SELECT {r('avg(CASE WHEN close IS NULL THEN 1.0 ELSE 0.0 END)')} AS close,
  {r('avg(CASE WHEN sma_7 IS NULL THEN 1.0 ELSE 0.0 END)')} AS sma_7,
  {r('avg(CASE WHEN rsi_14 IS NULL THEN 1.0 ELSE 0.0 END)')} AS rsi_14 FROM features""")
def missing_ratios(spark, sf):
    return P.missing_ratios(hourly_features(spark, sf), ["close", "sma_7", "rsi_14"])


@query(f"WITH {GAPPY} SELECT pair, window_start_ms, {r('open')} AS open, {r('close')} AS close, "
       f"{r('volume')} AS volume FROM gappy")
def drop_sparse_columns(spark, sf):
    """`rare` is known for almost no candle and goes; the others stay."""
    rows = gappy(spark, sf).withColumn("rare", F.when(F.col("open") > 400, F.col("open")))
    return P.drop_sparse_columns(rows, 0.8)


def _near(c: str, later: bool = False, value: str | None = None) -> str:
    word, span = ("first_value", "CURRENT ROW AND UNBOUNDED FOLLOWING") if later else (
        "last_value", "UNBOUNDED PRECEDING AND CURRENT ROW")
    return f"{word}({value or c} IGNORE NULLS) OVER ({ORDER} ROWS BETWEEN {span})"


def _fill_sql(first_later: bool) -> str:
    return (f"WITH {GAPPY} SELECT {KEPT}, {r('open')} AS open, " + ", ".join(
        r(f"coalesce({_near(c, first_later)}, {_near(c, not first_later)})") + f" AS {c}"
        for c in ("close", "volume")) + " FROM gappy")


@query(_fill_sql(False))
def fill_ffill(spark, sf):
    return P.fill_missing(gappy(spark, sf), "ffill", step_ms=STEP)


@query(_fill_sql(False))
def fill_nan(spark, sf):
    """NaN is as unknown as NULL."""
    rows = gappy(spark, sf)
    return P.fill_missing(rows.withColumns({c: F.coalesce(c, F.lit(float("nan"))) for c in ("close", "volume")}),
                          "ffill", step_ms=STEP)


@query(_fill_sql(True))
def fill_bfill(spark, sf):
    return P.fill_missing(gappy(spark, sf), "bfill", step_ms=STEP)


def _line_sql(c: str) -> str:
    at = f"CASE WHEN {c} IS NOT NULL THEN window_start_ms END"
    v0, v1, t0, t1 = (f"{c}_v0", f"{c}_v1", f"{c}_t0", f"{c}_t1")
    return (f"{_near(c)} AS {v0}, {_near(c, True)} AS {v1}, "
            f"{_near(c, False, at)} AS {t0}, {_near(c, True, at)} AS {t1}")


@query(f"WITH {GAPPY}, near AS (SELECT *, {_line_sql('close')}, {_line_sql('volume')} FROM gappy) "
       f"SELECT {KEPT}, {r('open')} AS open, " + ", ".join(
           r(f"coalesce({c}, {c}_v0 + ({c}_v1 - {c}_v0) * ((window_start_ms - {c}_t0) / nullif({c}_t1 - {c}_t0, 0)), "
             f"{c}_v0, {c}_v1)") + f" AS {c}" for c in ("close", "volume")) + " FROM near")
def fill_interpolate(spark, sf):
    return P.fill_missing(gappy(spark, sf), "interpolate", step_ms=STEP)


@query(f"WITH {GAPPY} SELECT {KEPT}, {r('open')} AS open, {r('close')} AS close, {r('volume')} AS volume "
       "FROM gappy WHERE close IS NOT NULL AND volume IS NOT NULL")
def fill_drop(spark, sf):
    return P.fill_missing(gappy(spark, sf), "drop")


@query(f"""WITH {bars_sql()}, later AS (SELECT *, lead(close, 5) OVER ({ORDER}) AS t FROM bars)
SELECT {CANDLE_OUT}, {r('t')} AS future_close_5m FROM later WHERE t IS NOT NULL""")
def target_lead(spark, sf):
    return P.add_target(bars(spark, sf), 5, step_ms=STEP)


@query(f"""WITH {bars_sql()} SELECT a.pair, a.window_start_ms, {r('a.close')} AS close, {r('b.close')} AS future_close_5m
FROM bars a JOIN bars b ON a.pair = b.pair AND b.window_start_ms = a.window_start_ms + {5 * STEP}""")
def target_by_time(spark, sf):
    rows = bars(spark, sf).select("pair", "window_start_ms", "close")
    return P.add_target(rows, 5, by="time", step_ms=STEP)


@query(f"""WITH {bars_sql()}, lagged AS (SELECT *, lag(close, 1) OVER w AS c1, lag(close, 3) OVER w AS c3,
  lag(volume, 1) OVER w AS v1, lag(volume, 3) OVER w AS v3 FROM bars WINDOW w AS ({ORDER}))
SELECT {CANDLE_OUT}, {r('c1')} AS close_lag_1, {r('c3')} AS close_lag_3, {r('v1')} AS volume_lag_1,
  {r('v3')} AS volume_lag_3 FROM lagged WHERE c3 IS NOT NULL""")
def lag_features(spark, sf):
    return P.add_lags(bars(spark, sf), ["close", "volume", "not_there"], [1, 3], step_ms=STEP)


SCALED = ["open", "high", "low", "close", "volume"]


def _scaled(columns: list[str], center: str, scale: str, source: str, digits: int = 6) -> str:
    return ", ".join(
        r(f"(x.{c} - s.{c}_c) / CASE WHEN s.{c}_s = 0 THEN 1 ELSE s.{c}_s END", digits) + f" AS {c}"
        for c in columns)


def _stats(columns: list[str], source: str, center: str = "avg({})", scale: str = "stddev_pop({})") -> str:
    return ("SELECT pair, " + ", ".join(f"{center.format(c)} AS {c}_c, {scale.format(c)} AS {c}_s"
                                        for c in columns) + f" FROM {source} GROUP BY pair")


@query(f"WITH {bars_sql()}, s AS ({_stats(SCALED, 'bars')}) "
       f"SELECT x.pair, {_scaled(SCALED, '', '', '')}, x.window_start_ms, x.window_end_ms, x.window_in_sec "
       "FROM bars x JOIN s ON x.pair = s.pair")
def scale_standard(spark, sf):
    rows = bars(spark, sf)
    return P.apply_scaler(rows, P.fit_scaler(rows))


ROBUST = ("quantile_cont({}, 0.5)", "quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25)")


@query(f"WITH {bars_sql()}, s AS ({_stats(SCALED, 'bars', *ROBUST)}) "
       f"SELECT x.pair, {_scaled(SCALED, '', '', '')}, x.window_start_ms, x.window_end_ms, x.window_in_sec "
       "FROM bars x JOIN s ON x.pair = s.pair")
def scale_robust(spark, sf):
    rows = bars(spark, sf)
    return P.apply_scaler(rows, P.fit_scaler(rows, kind="robust"))


_GLOBAL = "SELECT " + ", ".join(f"avg({c}) AS {c}_c, stddev_pop({c}) AS {c}_s" for c in SCALED) + " FROM bars"


@query(f"WITH {bars_sql()}, s AS ({_GLOBAL}) SELECT x.pair, {_scaled(SCALED, '', '', '')}, "
       "x.window_start_ms, x.window_end_ms, x.window_in_sec FROM bars x, s")
def scale_all_pairs(spark, sf):
    rows = bars(spark, sf)
    return P.apply_scaler(rows, P.fit_scaler(rows, keys=()))


PLACED = f"""{FEATURES}, placed AS (SELECT *, rn - 1 AS pos, n // 6 AS s,
  CASE WHEN rn - 1 >= n - n // 6 THEN 'test' WHEN rn - 1 >= n - 2 * (n // 6) THEN 'validation'
       ELSE 'train' END AS split FROM features)"""


@query(f"WITH {PLACED}, s AS ({_stats(SCALED, 'placed WHERE split = $$train$$')}) "
       f"SELECT x.pair, {_scaled(SCALED, '', '', '')}, x.window_start_ms, x.split "
       "FROM placed x JOIN s ON x.pair = s.pair")
def scale_fit_on_train(spark, sf):
    rows = L.split_train_validation_test(bars(spark, sf).select(
        "pair", *SCALED, "window_start_ms"), step_ms=STEP)
    scaler = P.fit_scaler(rows.filter("split = 'train'"), SCALED)
    return P.apply_scaler(rows, scaler)


@query(f"WITH {PLACED} SELECT pair, window_start_ms, split FROM placed")
def split_tvt(spark, sf):
    return L.split_train_validation_test(
        bars(spark, sf).select("pair", "window_start_ms"), step_ms=STEP)


@query(f"""WITH {PLACED} SELECT pair, window_start_ms, CAST(CASE WHEN pos < n - 5 * s THEN 0
  ELSE (pos - (n - 5 * s)) // s + 1 END AS INTEGER) AS fold FROM placed""")
def rolling_folds(spark, sf):
    return L.rolling_folds(bars(spark, sf).select("pair", "window_start_ms"), step_ms=STEP)


@query(f"""WITH {PLACED} SELECT pair, window_start_ms, CASE WHEN pos >= n - 24 THEN 'test'
  WHEN pos >= n - 48 THEN 'validation' ELSE 'train' END AS split FROM placed""")
def split_fixed_test_size(spark, sf):
    return L.split_train_validation_test(
        bars(spark, sf).select("pair", "window_start_ms"), test_size=24, step_ms=STEP)


@query(f"""WITH {PLACED} SELECT pair, window_start_ms, CASE WHEN rn <= floor(n * 0.7::DOUBLE) THEN 'train'
  WHEN rn <= floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM placed""")
def ratio_split(spark, sf):
    return L.split_by_ratio(bars(spark, sf).select("pair", "window_start_ms"), step_ms=STEP)


_DAY_MS = DAY * 1000


@query(f"""WITH {bars_sql()} SELECT pair, window_start_ms, CASE
  WHEN window_start_ms >= {AS_OF_MS - 7 * _DAY_MS} THEN 'test'
  WHEN window_start_ms >= {AS_OF_MS - 21 * _DAY_MS} THEN 'validation' ELSE 'train' END AS split
FROM bars WHERE window_start_ms >= {AS_OF_MS - 81 * _DAY_MS} AND window_start_ms < {AS_OF_MS}""")
def split_days(spark, sf):
    return L.split_by_days(bars(spark, sf).select("pair", "window_start_ms"), AS_OF_MS)


@query(f"""WITH {PLACED} SELECT pair, window_start_ms, CAST(CASE WHEN pos < (n // 5 + 1) * (n % 5)
  THEN pos // (n // 5 + 1) ELSE n % 5 + (pos - (n // 5 + 1) * (n % 5)) // (n // 5) END AS INTEGER) AS fold
FROM placed""")
def contiguous_folds(spark, sf):
    return contiguous(bars(spark, sf).select("pair", "window_start_ms"), 5, step_ms=STEP)


PREPARED = f"""{FEATURES}, complete AS (
  SELECT *, lead(close, 5) OVER ({ORDER}) AS t FROM features
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in COLUMNS)}),
x AS (SELECT * FROM complete WHERE t IS NOT NULL), s AS ({_stats(COLUMNS, 'x')})"""


@query(f"WITH {PREPARED} SELECT x.pair, {_scaled(COLUMNS, '', '', '')}, x.window_start_ms, x.window_end_ms, "
       f"x.window_in_sec, {r('x.t')} AS future_close_5m FROM x JOIN s ON x.pair = s.pair")
def prepare(spark, sf):
    """Clean, target, scale on all rows: the whole preparation for all pairs."""
    return P.prepare(hourly_features(spark, sf), 5, "drop", step_ms=STEP)
