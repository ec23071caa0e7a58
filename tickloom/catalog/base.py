"""Registration of queries, the test tables as trades and candles, and shared SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions.scalars import seconds_to_iso
from tickloom.operators.candles import candles
from tickloom.operators.indicators import indicators
from tickloom.session import materialize, ship, work_folder  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

HOUR, DAY = 3600, 86_400
AS_OF_MS = 1_706_659_200_000        # 2024-01-31, the day after the last event
SPLIT_MS = 1_705_363_200_000        # 2024-01-16, between the two drift periods
LATER = 1_000_000_000               # arrival offset of repeated rows


def query(sql: str | None = None, digits: int | None = 6, name: str | None = None):
    """Register a query; its double columns are rounded as in the SQL."""
    def add(fn):
        label = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # The tables hold times without a zone; they mean UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship(spark)
            made = fn(spark, sf_dir)
            return made if digits is None else rounded(made, digits)

        QUERIES[label] = run
        if sql is not None:
            ORACLES[label] = sql
        return fn
    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c)
                       for c, kind in df.dtypes])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- test tables as market data -------------------------------------------------------

def as_trades(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("product_id"), F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"),
        F.col("event_id").alias("seq"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_trades(table(spark, sf_dir, "events"))


def repeated_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trade twice; the repetition arrives later and cheaper."""
    once = trades(spark, sf_dir)
    again = once.withColumn("seq", F.col("seq") + LATER).withColumn("price", F.col("price") / 2)
    return once.unionByName(again)


def supplier_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trades of their supplier: many products, many trades per moment."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("product_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("timestamp_ms"),
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 10_000_000 + F.col("l_partkey")).alias("seq"))


def bars(spark: SparkSession, sf_dir: str, sec: int = HOUR) -> DataFrame:
    """Candles of the events, kept once: most queries read them several times."""
    return materialize(candles(trades(spark, sf_dir), sec))


def hourly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles with SMA and RSI of 7 and 14; the first ones of a pair are NULL."""
    return materialize(indicators(bars(spark, sf_dir), (7, 14), kinds=("sma", "rsi"),
                                  step_ms=HOUR * 1000))


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles in which low closes and thin volumes are unknown."""
    return bars(spark, sf_dir).select(
        "pair", "window_start_ms", "open",
        F.when(F.col("close") >= 25, F.col("close")).alias("close"),
        F.when(F.col("volume") >= 30, F.col("volume")).alias("volume"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trades as landed history pages of up to 100 trades, in order of arrival."""
    from tickloom.functions.series import number_rows, time_cell
    numbered = number_rows(trades(spark, sf_dir), ["product_id"], ["seq"],
                           time_cell("timestamp_ms", HOUR * 1000))
    # Prices below 1 are written as a word, so that such trades do not parse.
    price = F.when(F.col("price") < 1, F.lit("n/a")).otherwise(F.col("price").cast("string"))
    raw = F.array(price, F.col("quantity").cast("string"),
                  (F.col("timestamp_ms") / 1000).cast("decimal(16,3)").cast("string"),
                  F.lit("b"), F.lit("l"), F.lit(""))
    page = numbered.groupBy("product_id", F.expr("(rn - 1) div 100 + 1").alias("request_no")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seq", raw.alias("raw")))),
                    lambda e: e["raw"]).alias("trades"),
        F.max("timestamp_ms").alias("cursor"))
    result = F.create_map(
        F.concat(F.lit("X"), F.upper("product_id")), F.to_json("trades"),
        F.lit("last"), F.concat(F.lit('"'), F.col("cursor").cast("string"), F.lit('000000"')))
    # Assembled as text, because the trades and the cursor differ in type.
    body = F.concat(F.lit('{"error":[],"result":{'), F.array_join(F.transform(
        F.map_entries(result), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"])), ","),
        F.lit("}}"))
    # Every 17th page of a product is cut off, every 19th is an error.
    cut = F.substring(body, 1, 40)
    return page.select(
        "product_id", "request_no",
        F.when(F.col("request_no") % 17 == 16, cut)
        .when(F.col("request_no") % 19 == 18, F.lit('{"error":["EGeneral"],"result":{}}')).otherwise(body).alias("body"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trades as live messages with their arrival number; heartbeats, status messages and
    messages with something wrong are chosen by row."""
    iso = F.concat(seconds_to_iso(F.col("timestamp_ms") / 1000), F.lit("Z"))
    body = F.to_json(F.struct(F.lit("trade").alias("channel"), F.array(F.struct(
        F.col("product_id").alias("symbol"), "price", F.col("quantity").alias("qty"),
        iso.alias("timestamp"))).alias("data")))
    kind = F.col("seq") % 11
    return trades(spark, sf_dir).select(
        F.when(kind == 1, F.lit('{"channel":"heartbeat"}'))
        .when(kind == 2, F.lit('{"channel":"status","data":[]}'))
        .when(kind == 3, F.lit("no message"))
        .when(kind == 4, F.regexp_replace(body, '"timestamp":"[^"]*"', '"timestamp":"noon"'))
        .when(kind == 5, F.regexp_replace(body, '"symbol":"[^"]*",', ""))
        .otherwise(body).alias("value"), F.col("seq").alias("offset"))


def forecasts(df: DataFrame, target: str) -> DataFrame:
    """Three simple forecasts of the target beside it, as rows of pair, model, prediction."""
    return df.select(
        "pair", "window_start_ms", F.col(target).alias("actual"),
        F.explode(F.array(
            F.struct(F.lit("last").alias("model"), F.col("close").alias("prediction")),
            F.struct(F.lit("sma_7").alias("model"), F.col("sma_7").alias("prediction")),
            F.struct(F.lit("sma_14").alias("model"), F.col("sma_14").alias("prediction")))).alias("f")
    ).select("pair", "window_start_ms", "f.model", "actual", "f.prediction").filter(
        F.col("prediction").isNotNull())


# --- the same in SQL ------------------------------------------------------------------

def r(expression: str, digits: int = 6) -> str:
    """Rounded, with negative zero turned into zero."""
    return f"round({expression}, {digits}) + 0.0"


TRADES = """trades AS (
  SELECT event_type AS product_id, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
         epoch_us(ts) // 1000 AS timestamp_ms, event_id AS seq
  FROM events)"""

REPEATED = f"""{TRADES}, repeated AS (
  SELECT * FROM trades
  UNION ALL SELECT product_id, price / 2, quantity, timestamp_ms, seq + {LATER} FROM trades)"""

SUPPLIER = """supplier_trades AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS product_id, l_extendedprice / l_quantity AS price,
         l_quantity AS quantity, epoch_us(l_shipdate) // 1000 AS timestamp_ms,
         (l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey AS seq
  FROM lineitem)"""


def candle_sql(sec: int, source: str = "trades", order: str = "seq") -> str:
    w = sec * 1000
    return f"""SELECT product_id AS pair, arg_min(price, {order}) AS open, max(price) AS high,
       min(price) AS low, arg_max(price, {order}) AS close, sum(quantity) AS volume,
       (timestamp_ms // {w}) * {w} AS window_start_ms,
       (timestamp_ms // {w}) * {w} + {w} AS window_end_ms, {sec} AS window_in_sec
  FROM {source} GROUP BY product_id, timestamp_ms // {w}"""


def bars_sql(sec: int = HOUR) -> str:
    return f"{TRADES}, bars AS ({candle_sql(sec)})"


CANDLE_OUT = (f"pair, {r('open')} AS open, {r('high')} AS high, {r('low')} AS low, "
              f"{r('close')} AS close, {r('volume')} AS volume, window_start_ms, window_end_ms, "
              "window_in_sec")

MOVES = """moves AS (
  SELECT *, row_number() OVER w AS rn, close - lag(close) OVER w AS d,
         greatest(close - lag(close) OVER w, 0) AS up, greatest(lag(close) OVER w - close, 0) AS down,
         CASE WHEN high - lag(high) OVER w > lag(low) OVER w - low AND high - lag(high) OVER w > 0
              THEN high - lag(high) OVER w ELSE 0 END AS plus,
         CASE WHEN lag(low) OVER w - low > high - lag(high) OVER w AND lag(low) OVER w - low > 0
              THEN lag(low) OVER w - low ELSE 0 END AS minus
  FROM bars WINDOW w AS (PARTITION BY pair ORDER BY window_start_ms))"""


def frame(rows: int) -> str:
    return (f"OVER (PARTITION BY pair ORDER BY window_start_ms "
            f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)")


def rsi_sql(p: int) -> str:
    up, move = f"sum(up) {frame(p)}", f"sum(up + down) {frame(p)}"
    return f"CASE WHEN rn > {p} THEN CASE WHEN {move} > 0 THEN 100 * {up} / ({move}) ELSE 0 END END"


def sma_sql(p: int) -> str:
    return f"CASE WHEN rn >= {p} THEN avg(close) {frame(p)} END"


FEATURES = f"""{bars_sql()}, {MOVES}, features AS (
  SELECT pair, open, high, low, close, volume, window_start_ms, window_end_ms, window_in_sec,
         {sma_sql(7)} AS sma_7, {rsi_sql(7)} AS rsi_7, {sma_sql(14)} AS sma_14, {rsi_sql(14)} AS rsi_14,
         volume AS obv, rn, count(*) OVER (PARTITION BY pair) AS n
  FROM moves)"""

FEATURE_COLUMNS = ["open", "high", "low", "close", "volume", "sma_7", "rsi_7", "sma_14", "rsi_14", "obv"]
FEATURE_OUT = (f"{CANDLE_OUT}, " + ", ".join(f"{r(c)} AS {c}" for c in FEATURE_COLUMNS[5:]))

GAPPY = f"""{bars_sql()}, gappy AS (
  SELECT pair, window_start_ms, open, CASE WHEN close >= 25 THEN close END AS close,
         CASE WHEN volume >= 30 THEN volume END AS volume FROM bars)"""

FORECASTS = f"""{FEATURES}, targets AS (
  SELECT *, lead(close, 5) OVER (PARTITION BY pair ORDER BY window_start_ms) AS target FROM features),
forecasts AS (
  SELECT pair, window_start_ms, 'last' AS model, target AS actual, close AS prediction
  FROM targets WHERE target IS NOT NULL
  UNION ALL SELECT pair, window_start_ms, 'sma_7', target, sma_7 FROM targets
  WHERE target IS NOT NULL AND sma_7 IS NOT NULL
  UNION ALL SELECT pair, window_start_ms, 'sma_14', target, sma_14 FROM targets
  WHERE target IS NOT NULL AND sma_14 IS NOT NULL)"""

METRICS = (f"count(*) AS n_samples, {r('avg(abs(actual - prediction))')} AS mae, "
           f"{r('sqrt(avg((actual - prediction) ** 2))')} AS rmse, "
           f"{r('1 - sum((actual - prediction) ** 2) / nullif(var_pop(actual) * count(*), 0)')} AS r2")
