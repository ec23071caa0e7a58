"""Feeds, candles and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog.base import *  # noqa: F403
from tickloom.catalog.base import query, r
from tickloom.operators import candles as C, dedup as D, quality as Q
from tickloom.schemas import CANDLE
from tickloom.sinks.tables import from_keyed_json, keyed_json
from tickloom.sources import decode, tables as S

DAY_MS = DAY * 1000


@query(f"WITH {TRADES} SELECT * FROM trades", digits=None)
def trades_view(spark, sf):
    return trades(spark, sf)


@query(f"WITH {TRADES} SELECT * FROM trades WHERE timestamp_ms >= {AS_OF_MS - 7 * DAY_MS}", digits=None)
def trades_since(spark, sf):
    return S.trades_since(trades(spark, sf), AS_OF_MS, 7)


@query(f"""WITH {TRADES}, spans AS (
  SELECT product_id, count(*) AS trades, min(timestamp_ms) AS first_ms, max(timestamp_ms) AS last_ms
  FROM trades GROUP BY product_id)
SELECT product_id, trades, first_ms, last_ms, {r(f'(last_ms - first_ms) / {DAY_MS}.0')} AS days_covered,
       {r(f'least(100.0, (last_ms - first_ms) / {DAY_MS}.0 / 90.0 * 100.0)')} AS percent FROM spans""")
def backfill_progress(spark, sf):
    return S.backfill_progress(trades(spark, sf), 90)


@query(f"""WITH {TRADES}, steps AS (
  SELECT product_id, lag(timestamp_ms) OVER (PARTITION BY product_id ORDER BY timestamp_ms) AS last_ms,
         timestamp_ms AS next_ms FROM trades)
SELECT product_id, last_ms, next_ms, {r('(next_ms - last_ms) / 1000.0')} AS gap_sec
FROM steps WHERE next_ms - last_ms > 300000""")
def feed_gaps(spark, sf):
    return Q.feed_gaps(trades(spark, sf), 300)


@query(f"""WITH {SUPPLIER}, steps AS (
  SELECT product_id, lag(timestamp_ms) OVER (PARTITION BY product_id ORDER BY timestamp_ms) AS last_ms,
         timestamp_ms AS next_ms FROM supplier_trades)
SELECT product_id, last_ms, next_ms, {r('(next_ms - last_ms) / 1000.0')} AS gap_sec
FROM steps WHERE next_ms - last_ms > 172800000""")
def feed_gaps_supplier(spark, sf):
    return Q.feed_gaps(supplier_trades(spark, sf), 2 * DAY)


@query(f"""WITH {TRADES} SELECT product_id, max(timestamp_ms) AS last_ms,
       {AS_OF_MS} - max(timestamp_ms) > 300000 AS stale FROM trades GROUP BY product_id""")
def stale_feeds(spark, sf):
    return Q.stale_feeds(trades(spark, sf), AS_OF_MS, 300)


PAGE_OK = "(pos // 100 + 1) % 17 <> 16 AND (pos // 100 + 1) % 19 <> 18"
ISO = ("CASE WHEN timestamp_ms % 1000 = 0 THEN strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%dT%H:%M:%S') "
       "ELSE strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%dT%H:%M:%S.%f') END")


@query(f"""WITH {TRADES}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY seq) - 1 AS pos FROM trades),
parsed AS (SELECT *, CAST(timestamp_ms / 1000.0 AS DOUBLE) AS sec FROM numbered)
SELECT product_id, price, quantity, {ISO} AS timestamp,
       CAST(trunc(sec * 1000) AS BIGINT) AS timestamp_ms,
       (pos // 100 + 1) * 1000000 + pos % 100 AS seq
FROM parsed WHERE price >= 1 AND {PAGE_OK}""", digits=None)
def decode_pages(spark, sf):
    return decode.decode_pages(pages(spark, sf))


@query(f"""WITH {TRADES}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY seq) - 1 AS pos FROM trades)
SELECT product_id, pos // 100 + 1 AS request_no, CAST(pos % 100 AS INTEGER) AS position
FROM numbered WHERE price < 1 AND {PAGE_OK}""")
def rejected_trades(spark, sf):
    return decode.rejected_trades(pages(spark, sf)).select("product_id", "request_no", "position")


@query(f"""WITH {TRADES}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY seq) - 1 AS pos FROM trades)
SELECT DISTINCT product_id, pos // 100 + 1 AS request_no,
       CASE WHEN (pos // 100 + 1) % 17 = 16 THEN 'not a page' ELSE 'error' END AS reason
FROM numbered WHERE NOT ({PAGE_OK})""")
def rejected_pages(spark, sf):
    return decode.rejected_pages(pages(spark, sf)).select("product_id", "request_no", "reason")


@query(f"""WITH {TRADES} SELECT product_id, price, quantity, {ISO} || 'Z' AS timestamp, timestamp_ms,
       seq * 1000000 AS seq FROM trades WHERE seq % 11 NOT IN (1, 2, 3, 4, 5)""", digits=None)
def decode_messages(spark, sf):
    return decode.decode_messages(messages(spark, sf), arrival="offset")


@query(f"""WITH {TRADES} SELECT CASE seq % 11 WHEN 3 THEN 'not a message' WHEN 4 THEN 'no time'
       ELSE 'no product' END AS reason, count(*) AS messages FROM trades WHERE seq % 11 IN (3, 4, 5) GROUP BY 1""")
def rejected_messages(spark, sf):
    return decode.rejected_messages(messages(spark, sf)).groupBy("reason").agg(F.count("*").alias("messages"))


@query(f"""WITH {TRADES}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY seq) - 1 AS pos FROM trades)
SELECT product_id, pos // 100 + 1 AS request_no,
       CASE WHEN (pos // 100 + 1) % 17 = 16 THEN NULL WHEN (pos // 100 + 1) % 19 = 18 THEN 0
            ELSE CAST(count(*) AS INTEGER) END AS trades,
       CASE WHEN {PAGE_OK} THEN CAST(max(timestamp_ms) AS VARCHAR) || '000000' END AS cursor
FROM numbered GROUP BY product_id, pos // 100""")
def page_summary(spark, sf):
    return decode.page_summary(pages(spark, sf))


def hour_pages(spark, sf):
    """One fetch per product and hour, also where nothing was traded; the cursor moves once
    a day, so fetches of one day repeat it."""
    filled = C.fill_gaps(bars(spark, sf), HOUR)
    return filled.select(
        F.col("pair").alias("product_id"),
        F.expr("window_start_ms div 3600000").alias("request_no"),
        F.when(F.col("filled"), F.lit(0)).otherwise(F.lit(1)).alias("trades"),
        F.expr("CAST(window_start_ms div 86400000 AS STRING)").alias("cursor"))


@query(f"""WITH {bars_sql()}, spans AS (
  SELECT pair, min(window_start_ms) AS a, max(window_start_ms) AS b FROM bars GROUP BY pair),
hours AS (SELECT pair, unnest(range(a, b + 1, 3600000)) AS h FROM spans),
fetches AS (
  SELECT hours.pair AS product_id, h // 3600000 AS request_no, h // 86400000 AS cursor,
         CASE WHEN bars.pair IS NULL THEN 0 ELSE 1 END AS trades
  FROM hours LEFT JOIN bars ON bars.pair = hours.pair AND bars.window_start_ms = h),
filled AS (
  SELECT *, lag(cursor) OVER (PARTITION BY product_id ORDER BY request_no) AS was
  FROM fetches WHERE trades > 0),
runs AS (
  SELECT *, max(trades) OVER w AS most, row_number() OVER (PARTITION BY product_id ORDER BY request_no) AS rn
  FROM fetches WINDOW w AS (PARTITION BY product_id ORDER BY request_no ROWS 2 PRECEDING))
SELECT product_id, request_no, 'cursor_not_moving' AS problem FROM filled WHERE cursor = was
UNION ALL SELECT product_id, request_no, 'three_empty_pages' FROM runs WHERE most = 0 AND rn >= 3""")
def page_audit(spark, sf):
    return decode.page_audit(hour_pages(spark, sf))


@query(f"WITH {bars_sql()} SELECT {CANDLE_OUT} FROM bars")
def candles_1h(spark, sf):
    return C.candles(trades(spark, sf), HOUR)


@query(f"WITH {bars_sql(60)} SELECT {CANDLE_OUT} FROM bars")
def candles_1m(spark, sf):
    return C.candles(trades(spark, sf), 60)


@query(f"""WITH {TRADES}, priced AS (SELECT * REPLACE (CASE WHEN seq % 5 > 1 THEN price END AS price) FROM trades),
bars AS ({candle_sql(300, 'priced')}) SELECT {CANDLE_OUT} FROM bars""")
def candles_gappy(spark, sf):
    """Trades without a price neither open nor close a candle."""
    rows = trades(spark, sf)
    return C.candles(rows.withColumn("price", F.when(F.col("seq") % 5 > 1, F.col("price"))), 300)


@query(f"WITH {TRADES}, bars AS ({candle_sql(HOUR, order='(timestamp_ms, seq)')}) SELECT {CANDLE_OUT} FROM bars")
def candles_event_time(spark, sf):
    return C.candles(trades(spark, sf), HOUR, open_close_by="event_time")


# Prices divided by 32 end at the seventh decimal, so these are compared at eight.
@query(f"""WITH {SUPPLIER}, bars AS ({candle_sql(DAY, 'supplier_trades')}) SELECT pair, {r('open', 8)} AS open,
  {r('high', 8)} AS high, {r('low', 8)} AS low, {r('close', 8)} AS close, volume, window_start_ms, window_end_ms,
  window_in_sec FROM bars""", digits=8)
def candles_daily_supplier(spark, sf):
    return C.candles(supplier_trades(spark, sf), DAY)


@query(f"WITH {bars_sql(DAY)} SELECT {CANDLE_OUT} FROM bars")
def candles_rollup_1d(spark, sf):
    return C.roll_up(C.candles(trades(spark, sf), 60), DAY)


@query(f"""WITH {bars_sql()}, spans AS (
  SELECT pair, min(window_start_ms) AS a, max(window_start_ms) AS b FROM bars GROUP BY pair),
hours AS (SELECT pair, unnest(range(a, b + 1, 3600000)) AS h FROM spans),
joined AS (
  SELECT hours.pair, h, bars.pair IS NULL AS filled, open, high, low, volume,
         last_value(close IGNORE NULLS) OVER (PARTITION BY hours.pair ORDER BY h
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close
  FROM hours LEFT JOIN bars ON bars.pair = hours.pair AND bars.window_start_ms = h)
SELECT pair, {r('coalesce(open, close)')} AS open, {r('coalesce(high, close)')} AS high,
       {r('coalesce(low, close)')} AS low, {r('close')} AS close, {r('coalesce(volume, 0)')} AS volume,
       h AS window_start_ms, h + 3600000 AS window_end_ms, 3600 AS window_in_sec, filled FROM joined""")
def candles_filled_1h(spark, sf):
    return C.fill_gaps(bars(spark, sf), HOUR)


@query(f"WITH {bars_sql()} SELECT {CANDLE_OUT} FROM bars")
def one_resolution(spark, sf):
    both = C.candles(trades(spark, sf), HOUR).unionByName(C.candles(trades(spark, sf), DAY))
    return C.only_resolution(both, HOUR)


@query(f"WITH {bars_sql()} SELECT {CANDLE_OUT} FROM bars")
def topic_roundtrip(spark, sf):
    return from_keyed_json(keyed_json(C.candles(trades(spark, sf), HOUR)), CANDLE)


# --- de-duplication -------------------------------------------------------------------

def _first_sql(with_part: str, source: str, key: str, order: str, digits: int = 6) -> str:
    return f"""WITH {with_part}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS k FROM {source})
SELECT product_id, {r('price', digits)} AS price, {r('quantity')} AS quantity, timestamp_ms, seq
FROM ranked WHERE k = 1"""


@query(_first_sql(REPEATED, "repeated", "product_id, timestamp_ms", "seq"))
def dedup_first(spark, sf):
    return D.dedup(repeated_trades(spark, sf), "trades")


@query(_first_sql(REPEATED, "repeated", "product_id, timestamp_ms", "seq DESC"))
def dedup_last(spark, sf):
    return D.dedup(repeated_trades(spark, sf), "trades", keep="last")


@query(_first_sql(SUPPLIER, "supplier_trades", "product_id, timestamp_ms", "seq", 8), digits=8)
def dedup_first_supplier(spark, sf):
    return D.dedup(supplier_trades(spark, sf), "trades")


@query(_first_sql(SUPPLIER, "supplier_trades", "product_id, timestamp_ms, quantity", "seq", 8), digits=8)
def dedup_extra_key(spark, sf):
    return D.dedup(supplier_trades(spark, sf), "trades", extra_key=("quantity",))


@query(f"""WITH {REPEATED}, holed AS (
  SELECT CASE WHEN price < 10 THEN NULL ELSE product_id END AS product_id, price, quantity, timestamp_ms, seq
  FROM repeated), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY product_id, timestamp_ms ORDER BY seq) AS k FROM holed)
SELECT product_id, {r('price')} AS price, quantity, timestamp_ms, seq FROM ranked
WHERE k = 1 OR product_id IS NULL""")
def dedup_missing_key(spark, sf):
    holed = repeated_trades(spark, sf).withColumn(
        "product_id", F.when(F.col("price") >= 10, F.col("product_id")))
    return D.dedup(holed, "trades")


def _versions(spark, sf):
    """Hourly candles twice: from the small trades alone, then from all trades."""
    early = C.candles(trades(spark, sf).filter("quantity < 50"), HOUR).withColumn("seq", F.lit(1))
    whole = C.candles(trades(spark, sf), HOUR).withColumn("seq", F.lit(2))
    return early.unionByName(whole)


VERSIONS = f"""{TRADES}, early_trades AS (SELECT * FROM trades WHERE quantity < 50),
versions AS (SELECT *, 1 AS seq FROM ({candle_sql(HOUR, 'early_trades')})
  UNION ALL SELECT *, 2 FROM ({candle_sql(HOUR)}))"""


@query(f"""WITH {VERSIONS}, ranked AS (SELECT *, row_number() OVER (
  PARTITION BY pair, window_start_ms, window_end_ms ORDER BY seq DESC) AS k FROM versions)
SELECT {CANDLE_OUT} FROM ranked WHERE k = 1""")
def candle_revisions(spark, sf):
    return D.dedup(_versions(spark, sf), "candles", keep="last").drop("seq")


def _created(spark, sf):
    """Candle versions with a creation time that some of them lack."""
    return _versions(spark, sf).withColumn("created_at", F.when(
        F.col("volume") >= 20, F.timestamp_millis(F.col("window_end_ms") - F.col("seq") * 1000)))


CREATED = f"""{VERSIONS}, created AS (SELECT *, CASE WHEN volume >= 20
  THEN make_timestamp((window_end_ms - seq * 1000) * 1000) END AS created_at FROM versions)"""


@query(f"""WITH {CREATED}, ranked AS (SELECT *, row_number() OVER (
  PARTITION BY pair, window_start_ms, window_end_ms ORDER BY created_at DESC NULLS LAST, seq DESC) AS k
  FROM created)
SELECT {CANDLE_OUT}, CAST(seq AS INTEGER) AS seq FROM ranked WHERE k = 1""")
def dedup_latest(spark, sf):
    return D.latest_per_key(_created(spark, sf)).drop("created_at")


@query(f"""WITH {SUPPLIER} SELECT 'trades' AS stream,
  count(DISTINCT (product_id, timestamp_ms)) AS processed,
  count(*) - count(DISTINCT (product_id, timestamp_ms)) AS duplicates,
  count(DISTINCT (product_id, timestamp_ms)) AS cache_size FROM supplier_trades""")
def dedup_stats(spark, sf):
    return D.dedup_stats(supplier_trades(spark, sf), "trades")


@query(f"""WITH {VERSIONS} SELECT count(*) AS total_records,
  count(DISTINCT (pair, window_start_ms, window_end_ms)) AS unique_records,
  count(*) - count(DISTINCT (pair, window_start_ms, window_end_ms)) AS duplicates FROM versions""")
def duplicate_counts(spark, sf):
    return D.duplicate_counts(_versions(spark, sf))


@query(f"""WITH {SUPPLIER} SELECT product_id, timestamp_ms, count(*) AS duplicate_count
FROM supplier_trades GROUP BY product_id, timestamp_ms HAVING count(*) > 1""")
def duplicate_report(spark, sf):
    return D.duplicate_report(supplier_trades(spark, sf), D.KEYS["trades"])


@query(f"""WITH {CREATED} SELECT pair, window_start_ms, window_end_ms, count(*) AS duplicate_count,
  min(created_at) AS first_created, max(created_at) AS last_created
FROM created GROUP BY pair, window_start_ms, window_end_ms HAVING count(*) > 1""")
def duplicate_monitor(spark, sf):
    return D.duplicate_report(_created(spark, sf), created="created_at")


@query(f"""WITH {bars_sql()} SELECT pair, CAST(make_timestamp(window_start_ms // 1000 * 1000000) AS DATE) AS trading_date,
  count(*) AS candle_count, make_timestamp(min(window_start_ms) * 1000) AS first_candle,
  make_timestamp(max(window_start_ms) * 1000) AS last_candle FROM bars GROUP BY 1, 2""")
def consistency_by_day(spark, sf):
    return Q.consistency_by_day(C.candles(trades(spark, sf), HOUR))


@query(f"""WITH {TRADES}, counted AS (SELECT event_type AS pair, (epoch_us(ts) // 1000 // 3600000) * 3600000 AS window_start_ms,
  count(*) AS trades, {r('sum(value * CAST(json_extract_string(props, $$$.k$$) AS DOUBLE))')} AS turnover FROM events GROUP BY ALL),
bars AS ({candle_sql(HOUR)})
SELECT {CANDLE_OUT}, trades, turnover FROM bars JOIN counted USING (pair, window_start_ms)""")
def candles_with_own_aggregates(spark, sf):
    """Aggregates of one's own beside the five of a candle."""
    own = [F.count(F.lit(1)).alias("trades"), F.sum(F.col("price") * F.col("quantity")).alias("turnover")]
    return C.candles(trades(spark, sf), HOUR, extra=own)
