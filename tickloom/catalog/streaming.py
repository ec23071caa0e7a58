"""Streams over the test tables, run to their end and read back.

Each has the batch result as its twin: the last update of every window is the whole window.
"""

from __future__ import annotations

from pyspark.sql import Window, functions as F, types as T

from tickloom.catalog.base import *  # noqa: F403
from tickloom.catalog.base import query, r
from tickloom.catalog.indicators import FLAGSHIP, _macd_tail
from tickloom.operators import candles as C
from tickloom.schemas import CANDLE
from tickloom.sinks.tables import from_keyed_json, keyed_json
from tickloom.sources.tables import read_feature_table
from tickloom.streaming import flows, perkey
from tickloom.streaming.stateful import indicator_stream

TRADE_MESSAGE = T.StructType([
    T.StructField("product_id", T.StringType()), T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()), T.StructField("timestamp_ms", T.LongType()),
    T.StructField("seq", T.LongType())])


def stream_session(spark):
    """A session with its own settings for the stream; results are read in the caller's.

    The list state of the indicators needs RocksDB, and a local run one state partition per
    core.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    if spark.sparkContext.master.startswith("local"):
        own.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    return own


def event_stream(spark, sf):
    own = stream_session(spark)
    schema = table(own, sf, "events").schema
    return as_trades(own.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf))


def finish(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


@query(f"WITH {bars_sql()} SELECT {CANDLE_OUT} FROM bars")
def stream_candles(spark, sf):
    """Every update of a candle, upserted: the table ends up with whole candles."""
    home = work_folder(spark)
    made = flows.candle_stream(flows.with_event_time(event_stream(spark, sf)), HOUR)
    finish(flows.to_feature_table(made, f"{home}/table", f"{home}/state", mode="update"))
    return read_feature_table(spark, f"{home}/table").select(*C.COLUMNS)


@query(f"""WITH {bars_sql()}, ended AS (SELECT *, (SELECT max(timestamp_ms) FROM trades) - 600000 AS mark FROM bars)
SELECT {CANDLE_OUT} FROM ended WHERE window_end_ms <= mark""")
def stream_candles_closed(spark, sf):
    """Closed candles only: those that end before the newest trade less the ten minutes."""
    home = work_folder(spark)
    made = flows.candle_stream(flows.with_event_time(event_stream(spark, sf)), HOUR)
    finish(flows.to_topic(made, f"{home}/state", f"{home}/topic"))
    return from_keyed_json(spark.read.schema("key string, value string").json(f"{home}/topic"), CANDLE)


@query(f"""WITH {TRADES} SELECT product_id, {r('price')} AS price, {r('quantity')} AS quantity, timestamp_ms, seq FROM trades""")
def stream_dedup(spark, sf):
    """Trades that arrive twice leave once."""
    home = work_folder(spark)
    trade_stream = event_stream(spark, sf)
    twice = trade_stream.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    seen = flows.dedup_stream(flows.with_event_time(twice, delay="1 hour"), "trades").drop("event_time")
    finish(flows.to_topic(seen, f"{home}/state", f"{home}/topic", key="product_id"))
    return from_keyed_json(spark.read.schema("key string, value string").json(f"{home}/topic"), TRADE_MESSAGE)


@query(f"WITH {TRADES} SELECT product_id, {r('price')} AS price, {r('quantity')} AS quantity, timestamp_ms, seq FROM trades")
def stream_backfill(spark, sf):
    """Landed history published batch by batch, and read back."""
    home = work_folder(spark)
    keyed_json(trades(spark, sf), "product_id").repartition(4).write.json(f"{home}/landed")
    flows.publish_backfill(stream_session(spark), TRADE_MESSAGE, f"{home}/landed", f"{home}/topic", f"{home}/state",
                           files_per_batch=2).awaitTermination()
    return from_keyed_json(spark.read.schema("key string, value string").json(f"{home}/topic"), TRADE_MESSAGE)


@query(FLAGSHIP.replace(", CAST(NULL AS TIMESTAMP) AS created_at", ""))
def stream_indicators(spark, sf):
    """Candles as messages through the stateful indicators into the feature table."""
    home = work_folder(spark)
    keyed_json(C.candles(trades(spark, sf), HOUR)).repartitionByRange(3, "value").write.json(f"{home}/candles")
    rows = C.only_resolution(flows.topic(stream_session(spark), CANDLE, f"{home}/candles"), HOUR)
    finish(flows.to_feature_table(indicator_stream(rows, max_history=60), f"{home}/table", f"{home}/state"))
    return read_feature_table(spark, f"{home}/table")


@query(FLAGSHIP.replace(", CAST(NULL AS TIMESTAMP) AS created_at", ""))
def stream_indicators_revised(spark, sf):
    """Candles that are revised twice, stale repeats of them, and revisions that come too late:
    the table ends up as if only the last versions had arrived."""
    home, own = work_folder(spark), stream_session(spark)
    made = materialize(C.candles(trades(spark, sf), HOUR))
    back = F.row_number().over(Window.partitionBy("pair").orderBy(F.desc("window_start_ms")))
    ranked = materialize(made.withColumn("back", back))

    def send(rows, change: float, arrival: int):
        moved = rows.withColumns({c: F.col(c) + F.lit(change) for c in ("open", "high", "low", "close")})
        keyed_json(moved.drop("back").withColumn("arrival", F.lit(arrival))).coalesce(1).write.mode("append").json(f"{home}/candles")

    send(ranked.filter("back > 60"), 0.0, 1)
    send(ranked.filter("back <= 60"), 5.0, 1)
    send(ranked.filter("back <= 60"), 9.0, 2)
    send(ranked.filter("back <= 60"), 0.0, 3)
    send(ranked.filter("back between 3 and 40"), 7.0, 2)        # stale
    send(ranked.filter("back > 100"), 11.0, 4)                  # too late
    schema = T.StructType([*CANDLE.fields, T.StructField("arrival", T.LongType())])
    rows = flows.topic(own, schema, f"{home}/candles", max_files=1)
    finish(flows.to_feature_table(indicator_stream(rows, max_history=60, arrival="arrival"), f"{home}/table", f"{home}/state"))
    return read_feature_table(spark, f"{home}/table")


@query(f"""WITH {TRADES} SELECT product_id, {r('price')} AS price, {r('quantity')} AS quantity, timestamp_ms, seq
FROM trades WHERE seq % 3 <> 0""")
def stream_without_empty(spark, sf):
    """Rows without a value leave the stream."""
    home = work_folder(spark)
    rows = event_stream(spark, sf).withColumn("price", F.when(F.col("seq") % 3 != 0, F.col("price")))
    finish(flows.to_topic(flows.not_empty(rows, "price"), f"{home}/state", f"{home}/topic", key="product_id"))
    return from_keyed_json(spark.read.schema("key string, value string").json(f"{home}/topic"), TRADE_MESSAGE)


@query(f"WITH {TRADES} SELECT 2 * count(*) AS rows_in, count(DISTINCT (product_id, timestamp_ms)) AS rows_out FROM trades")
def stream_dedup_counts(spark, sf):
    """Rows before and after the removal of repeats, from the progress events."""
    home = work_folder(spark)
    twice = event_stream(spark, sf).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    seen = flows.dedup_counts(twice, "trades")
    running = flows.to_topic(seen.drop("event_time"), f"{home}/state", f"{home}/topic", key="product_id").trigger(
        availableNow=True).start()
    running.awaitTermination()
    found = [p["observedMetrics"] for p in running.recentProgress if p["observedMetrics"]]
    rows = [sum(m[f"trades_{side}"]["rows"] for m in found if f"trades_{side}" in m) for side in ("in", "out")]
    return spark.createDataFrame([tuple(rows)], "rows_in long, rows_out long")


@query(f"""WITH {bars_sql()}, own AS (SELECT product_id AS pair, max(timestamp_ms) - 600000 AS mark FROM trades GROUP BY product_id)
SELECT {CANDLE_OUT}, 'closed' AS status FROM bars JOIN own USING (pair) WHERE window_end_ms <= mark""")
def stream_candles_per_pair(spark, sf):
    """Two products come in a week after the others: every pair's candles close by its own clock."""
    home = work_folder(spark)
    week = F.expr("(timestamp_ms - 1704067200000) div 604800000L") + F.when(
        F.col("product_id").isin("view", "error"), 1).otherwise(0)
    arriving = materialize(trades(spark, sf).withColumn("week", week))
    for n in range(6):
        keyed_json(arriving.filter(F.col("week") == n).drop("week"), "product_id").coalesce(1).write.mode("append").json(
            f"{home}/trades")
    made = perkey.pair_candle_stream(
        flows.topic(stream_session(spark), TRADE_MESSAGE, f"{home}/trades", max_files=1), HOUR)
    finish(flows.to_topic(made, f"{home}/state", f"{home}/topic"))
    return from_keyed_json(spark.read.schema("key string, value string").json(f"{home}/topic"), perkey.STATUS)


@query(f"""WITH {TRADES}, fed AS (SELECT * FROM trades WHERE product_id <> 'view' OR timestamp_ms < {SPLIT_MS}),
mark AS (SELECT max(timestamp_ms) - 600000 AS mark FROM fed),
last AS (SELECT product_id, max(timestamp_ms) AS last_ms FROM fed GROUP BY product_id)
SELECT product_id, last_ms, last_ms + 300000 AS due_ms FROM last, mark WHERE mark - last_ms > 300000""")
def silence_alarms_live(spark, sf):
    """One product falls silent half-way: an alarm without a further trade of it, from a timer."""
    home = work_folder(spark)
    rows = event_stream(spark, sf).filter((F.col("product_id") != "view") | (F.col("timestamp_ms") < SPLIT_MS))
    made = perkey.silence_alarms(rows, 300, clock="event", delay="10 minutes")
    finish(flows.to_topic(made, f"{home}/state", f"{home}/topic", key="product_id"))
    return from_keyed_json(spark.read.schema("key string, value string").json(f"{home}/topic"), perkey.ALARM)


@query(f"""WITH {TRADES} SELECT product_id, {r('price')} AS price, {r('quantity')} AS quantity, timestamp_ms, seq FROM trades""")
def stream_dedup_arrival(spark, sf):
    """Trades that come again, in a later run, within the life time of their key, which counts from arrival."""
    home = work_folder(spark)
    for again in (0, LATER):
        keyed_json(trades(spark, sf).withColumn("seq", F.col("seq") + again), "product_id").write.mode("append").json(
            f"{home}/trades")
        rows = flows.topic(stream_session(spark), TRADE_MESSAGE, f"{home}/trades")
        seen = perkey.dedup_by_arrival(rows, "trades", ttl_sec=86_400)
        finish(flows.to_topic(seen, f"{home}/state", f"{home}/topic", key="product_id"))
    return from_keyed_json(spark.read.schema("key string, value string").json(f"{home}/topic"), TRADE_MESSAGE)


@query(f"""WITH {bars_sql()}, joined AS (
  SELECT a.pair, a.window_start_ms, a.close AS prediction, b.close AS actual FROM bars a
  LEFT JOIN bars b ON a.pair = b.pair AND b.window_start_ms = a.window_start_ms + 18000000)
SELECT pair, window_start_ms // 86400000 * 86400000 AS bucket_ms, count(actual) AS n_samples,
  {r('avg(abs(actual - prediction))')} AS mae, count(*) - count(actual) AS without_candle,
  coalesce(avg(abs(actual - prediction)) > 50, false) AS alarm FROM joined GROUP BY 1, 2""")
def stream_prediction_alarms(spark, sf):
    """Errors of a forecast per day as the candles come in, with those that had none."""
    home, own = work_folder(spark), stream_session(spark)
    made = materialize(C.candles(trades(spark, sf), HOUR))
    # A candle far ahead moves the clock past all others, as the next days would.
    end = spark.createDataFrame([("_end", 2 * AS_OF_MS, 1.0)], "pair string, window_start_ms long, close double")
    rows = made.select("pair", "window_start_ms", "close").unionByName(end)
    rows.write.parquet(f"{home}/candles")
    rows.withColumnRenamed("close", "prediction").write.parquet(f"{home}/predictions")
    candle_rows = own.readStream.schema("pair string, window_start_ms long, close double").parquet(f"{home}/candles")
    predictions = own.readStream.schema("pair string, window_start_ms long, prediction double").parquet(f"{home}/predictions")
    found = flows.prediction_alarm_stream(predictions, candle_rows, 5 * HOUR * 1000, 50.0)
    schema = found.schema
    finish(flows.to_topic(found, f"{home}/state", f"{home}/topic"))
    return from_keyed_json(spark.read.schema("key string, value string").json(f"{home}/topic"), schema).filter("pair <> '_end'")
