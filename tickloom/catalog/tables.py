"""Reading, panels, exports and the upserted feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog.base import *  # noqa: F403
from tickloom.catalog.base import query
from tickloom.operators import candles as C, prep as P, selection as S
from tickloom.sinks import tables as K
from tickloom.sources.tables import read_feature_table

DAY_MS = DAY * 1000
PICK = "make_timestamp(window_start_ms * 1000)"


@query(f"WITH {TRADES} SELECT DISTINCT product_id AS pair FROM trades")
def distinct_pairs(spark, sf):
    return S.distinct_pairs(C.candles(trades(spark, sf), HOUR))


@query(f"""WITH {bars_sql()} SELECT {CANDLE_OUT}, {PICK} AS timestamp FROM bars
ORDER BY window_start_ms DESC, pair LIMIT 50""")
def latest_rows(spark, sf):
    return S.latest_rows(C.candles(trades(spark, sf), HOUR), limit=50)


@query(f"""WITH {bars_sql()} SELECT {CANDLE_OUT}, {PICK} AS timestamp FROM bars WHERE pair = 'purchase'
ORDER BY window_start_ms DESC""")
def latest_rows_of_pair(spark, sf):
    return S.latest_rows(C.candles(trades(spark, sf), HOUR), "purchase")


@query(f"""WITH {bars_sql()} SELECT {CANDLE_OUT}, {PICK} AS timestamp FROM bars
WHERE pair = 'click' AND window_start_ms > {AS_OF_MS - 10 * DAY_MS}""")
def pair_last_days(spark, sf):
    return S.pair_last_days(C.candles(trades(spark, sf), HOUR), "click", 10, AS_OF_MS)


@query(f"WITH {bars_sql()} SELECT {CANDLE_OUT} FROM bars WHERE window_start_ms >= {AS_OF_MS - 14 * DAY_MS}")
def training_horizon(spark, sf):
    return S.training_horizon(C.candles(trades(spark, sf), HOUR), 14, AS_OF_MS)


@query(f"""WITH {bars_sql()}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY pair ORDER BY window_start_ms DESC) AS k FROM bars)
SELECT {CANDLE_OUT} FROM ranked WHERE k <= 100""")
def newest_100_per_pair(spark, sf):
    return S.newest_per_pair(C.candles(trades(spark, sf), HOUR), 100)


@query(f"""WITH {bars_sql()} SELECT pair, window_start_ms, window_end_ms, CAST(NULL AS TIMESTAMP) AS created_at,
  {PICK} AS window_start_time FROM bars ORDER BY pair, window_start_ms DESC LIMIT 20""")
def sample_check(spark, sf):
    rows = C.candles(trades(spark, sf), HOUR).withColumn("created_at", F.lit(None).cast("timestamp"))
    return S.sample_check(rows, 20)


@query(f"""WITH {bars_sql()} SELECT pair, {PICK} AS time, open, high, low, close FROM bars
WHERE pair IN ('click', 'view') AND window_start_ms BETWEEN {AS_OF_MS - 5 * DAY_MS} AND {AS_OF_MS}""")
def price_panel(spark, sf):
    return S.price_panel(C.candles(trades(spark, sf), HOUR), ["click", "view"],
                         AS_OF_MS - 5 * DAY_MS, AS_OF_MS)


@query(f"""WITH {FEATURES} SELECT pair, {PICK} AS time, {r('obv')} AS obv, {r('sma_7')} AS sma_7,
  {r('sma_14')} AS sma_14 FROM features
WHERE pair = 'purchase' AND window_start_ms BETWEEN {AS_OF_MS - 20 * DAY_MS} AND {AS_OF_MS}""")
def indicator_panel(spark, sf):
    return S.indicator_panel(hourly_features(spark, sf), ["obv", "sma_7", "sma_14"], ["purchase"],
                             AS_OF_MS - 20 * DAY_MS, AS_OF_MS)


@query(f"""WITH {FEATURES} SELECT pair, {r('open')} AS open, {r('high')} AS high, {r('low')} AS low,
  {r('volume')} AS volume, window_start_ms, window_end_ms, window_in_sec, {r('sma_7')} AS sma_7,
  {r('rsi_7')} AS rsi_7, {r('sma_14')} AS sma_14, {r('rsi_14')} AS rsi_14, {r('obv')} AS obv,
  {r('close')} AS close FROM features""")
def feature_matrix(spark, sf):
    rows = hourly_features(spark, sf).withColumn("timestamp", F.timestamp_millis("window_start_ms"))
    return P.feature_matrix(rows, "close", keep=("pair",))


@query(f"""WITH {bars_sql()}, later AS (
  SELECT pair, window_start_ms, lead(close, 5) OVER (PARTITION BY pair ORDER BY window_start_ms) AS target
  FROM bars)
SELECT pair, window_start_ms, {r('close')} AS close, {r('target')} AS target
FROM bars JOIN later USING (pair, window_start_ms) WHERE target IS NOT NULL""")
def align_target(spark, sf):
    rows = bars(spark, sf)
    target = P.add_target(rows, 5, "target", step_ms=HOUR * 1000).select("pair", "window_start_ms", "target")
    return S.align_target(rows.select("pair", "window_start_ms", "close"), target)


@query(f"""WITH {bars_sql()} SELECT {CANDLE_OUT} FROM bars ORDER BY window_start_ms, pair LIMIT 100""")
def sample_100(spark, sf):
    return K.sample(C.candles(trades(spark, sf), HOUR), 100)


@query(f"WITH {bars_sql()} SELECT {CANDLE_OUT} FROM bars")
def clean_copy(spark, sf):
    """Every candle twice, replaced by a clean copy and read back."""
    rows = C.candles(trades(spark, sf), HOUR).withColumn("created_at", F.lit(None).cast("timestamp"))
    twice = rows.withColumn("seq", F.lit(1)).unionByName(rows.withColumn("seq", F.lit(2)))
    path = f"{work_folder(spark)}/clean"
    K.replace_with_clean_copy(twice, path)
    return spark.read.parquet(path).drop("created_at")


@query(f"""WITH {FEATURES} SELECT pair, {r('close')} AS close, window_start_ms, window_end_ms,
  {r('sma_7')} AS sma_7 FROM features""")
def feature_upsert(spark, sf):
    """Three upserts: first values, the real ones, and the real ones again as a retry."""
    rows = hourly_features(spark, sf).select("pair", "close", "window_start_ms", "window_end_ms", "sma_7")
    path = f"{work_folder(spark)}/features"
    K.upsert(rows.withColumn("close", F.lit(0.0)), 0, path)
    K.upsert(rows, 1, path)
    K.upsert(rows, 1, path)
    return read_feature_table(spark, path)


@query(f"""WITH {FEATURES} SELECT pair, {r('close')} AS close, window_start_ms, window_end_ms,
  {r('sma_7')} AS sma_7 FROM features
WHERE pair = 'click' AND window_start_ms >= {AS_OF_MS - 10 * DAY_MS}""")
def feature_table_pruned(spark, sf):
    rows = hourly_features(spark, sf).select("pair", "close", "window_start_ms", "window_end_ms", "sma_7")
    path = f"{work_folder(spark)}/features"
    K.upsert(rows, 0, path)
    return read_feature_table(spark, path, "click", AS_OF_MS - 10 * DAY_MS)
