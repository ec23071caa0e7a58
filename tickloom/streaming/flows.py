"""Streams of trades, candles and indicators.

Two queries with a table or topic between them: the candle query emits every update of a
window, which cannot feed a second stateful operator in the same query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tickloom.operators.candles import COLUMNS, ohlcv
from tickloom.operators.dedup import KEYS, _complete
from tickloom.sinks.tables import from_keyed_json, keyed_json, upsert


def topic(spark: SparkSession, schema: StructType, path: str | None = None,
          max_files: int | None = None, **kafka: str) -> DataFrame:
    """Rows of a topic with JSON values.

    From Kafka when its options are given (connector on the class path); otherwise from a
    landing folder of JSON lines `{"key": ..., "value": ...}`. Kafka rows get their offset
    as `seq` when the schema asks for it.
    """
    if kafka:
        raw = spark.readStream.format("kafka").options(**kafka).load()
        rows = raw.select(F.from_json(F.col("value").cast("string"), schema).alias("v"), "offset")
        arrival = [F.col("offset").alias("seq")] if "seq" in schema.names else []
        return rows.select(*[F.col("v")[n].alias(n) for n in schema.names if n != "seq"], *arrival)
    reader = spark.readStream.schema("key string, value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return from_keyed_json(reader.json(path), schema)


def with_event_time(df: DataFrame, ms: str | Column = "timestamp_ms", delay: str = "10 minutes"
                    ) -> DataFrame:
    """Event time from the payload, and the time after which late rows are dropped.

    `ms` names the field, or is an expression that extracts epoch milliseconds.
    """
    ms = F.col(ms) if isinstance(ms, str) else ms
    return df.withColumn("event_time", F.timestamp_millis(ms)).withWatermark("event_time", delay)


def candle_stream(trades: DataFrame, window_in_sec: int, arrival: str | None = "seq") -> DataFrame:
    """Candles of a stream that has passed `with_event_time`.

    Output mode "update" emits every change of an open candle, "append" closed ones only.
    """
    order = F.col(arrival or "timestamp_ms")
    made = trades.groupBy(F.col("product_id").alias("pair"),
                          F.window("event_time", f"{window_in_sec} seconds").alias("w")).agg(*ohlcv(order))
    return made.select(
        "*", F.unix_millis("w.start").alias("window_start_ms"),
        F.unix_millis("w.end").alias("window_end_ms"),
        F.lit(window_in_sec).alias("window_in_sec")).select(*COLUMNS)


def dedup_stream(df: DataFrame, kind: str, extra_key: tuple[str, ...] = ()) -> DataFrame:
    """First row per key within the watermark delay, which is the life time of a key.

    Rows with a missing key part go round the state.
    """
    if kind not in KEYS:
        return df
    key = KEYS[kind] + list(extra_key)
    known = df.filter(_complete(key)).dropDuplicatesWithinWatermark(key)
    return known.unionByName(df.filter(~_complete(key)))


def not_empty(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def counted(df: DataFrame, name: str) -> DataFrame:
    """Count the rows of each micro-batch in the query's progress events."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def dedup_counts(df: DataFrame, kind: str, ttl: str = "1 hour", ms: str = "timestamp_ms") -> DataFrame:
    """`dedup_stream` with the rows before and after it counted per micro-batch."""
    seen = with_event_time(counted(df, f"{kind}_in"), ms, ttl)
    return counted(dedup_stream(seen, kind), f"{kind}_out")


def to_topic(df: DataFrame, checkpoint: str, path: str | None = None, key: str = "pair",
             mode: str = "append", **kafka: str) -> DataStreamWriter:
    """Writer of keyed JSON messages to Kafka, or to a folder of JSON lines.

    A folder takes closed rows only (append); updates go to Kafka or `to_feature_table`.
    """
    out = keyed_json(df, key).writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if kafka:
        return out.format("kafka").options(**kafka)
    return out.format("json").option("path", path)


def to_feature_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                     run: int = 0) -> DataStreamWriter:
    """Writer that upserts each micro-batch into the feature table.

    With a new checkpoint on an existing table, raise `run`: batches count from 0 again. Of
    several rows of a key in a micro-batch the one with the highest `version` stays, where the
    stream has that column.
    """
    def store(rows: DataFrame, batch_id: int) -> None:
        if "version" in rows.columns:
            ordered = rows.withColumnRenamed("version", "_arrival")
            upsert(ordered, batch_id, path, F.col("_arrival"), run)
        else:
            upsert(rows, batch_id, path, run=run)

    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(store)


def publish_backfill(spark: SparkSession, schema: StructType, landed: str, path: str,
                     checkpoint: str, files_per_batch: int = 1, key: str = "product_id"):
    """Publish landed history batch by batch, then stop; restarts where it left off."""
    rows = topic(spark, schema, landed, max_files=files_per_batch)
    return to_topic(rows, checkpoint, path, key=key).trigger(availableNow=True).start()


def publish_all(df: DataFrame, path: str, key: str = "product_id") -> None:
    """Publish a whole history in one batch write."""
    keyed_json(df, key).write.mode("append").json(path)


def prediction_error_stream(predictions: DataFrame, candle_rows: DataFrame, horizon_ms: int,
                            delay: str = "10 minutes", unmatched: bool = False) -> DataFrame:
    """Predictions joined to the candle that closes `horizon_ms` later, with the error.

    A prediction (pair, window_start_ms, prediction) waits in state until its candle is
    there, or the watermark has passed it. With `unmatched` it leaves then, without `actual`.
    """
    made = _due(predictions, candle_rows, horizon_ms, delay, "left" if unmatched else "inner")
    return made.select("pair", "window_start_ms", "prediction", "actual", "abs_error")


def _due(predictions: DataFrame, candle_rows: DataFrame, horizon_ms: int, delay: str, how: str) -> DataFrame:
    due = with_event_time(predictions.withColumn(
        "due_ms", F.col("window_start_ms") + F.lit(horizon_ms)), "due_ms", delay).select(
        "pair", "window_start_ms", "prediction", F.col("event_time").alias("due_time"))
    actual = with_event_time(candle_rows, "window_start_ms", delay).select(
        F.col("pair").alias("_pair"), F.col("event_time").alias("_time"), F.col("close").alias("actual"))
    joined = due.join(actual, (F.col("pair") == F.col("_pair")) & (F.col("due_time") == F.col("_time")), how)
    return joined.withColumn("abs_error", F.abs(F.col("actual") - F.col("prediction")))


def prediction_alarm_stream(predictions: DataFrame, candle_rows: DataFrame, horizon_ms: int, max_mae: float,
                            bucket_ms: int = 86_400_000, delay: str = "10 minutes") -> DataFrame:
    """Per pair and bucket of prediction times: the error once all its candles are due, the
    predictions whose candle never came, and whether the error is above `max_mae`.

    Two stateful steps in one query, in append mode: the outer join lets a prediction go when
    the watermark has passed its candle, and a bucket leaves when it has passed the bucket.
    """
    joined = _due(predictions, candle_rows, horizon_ms, delay, "left")
    # Buckets of the due time, moved by the horizon so that they are buckets of the prediction.
    window = F.window("due_time", f"{bucket_ms} milliseconds", startTime=f"{horizon_ms % bucket_ms} milliseconds")
    made = joined.groupBy("pair", window.alias("w")).agg(
        F.count("actual").alias("n_samples"), F.avg("abs_error").alias("mae"),
        F.count_if(F.col("actual").isNull()).alias("without_candle"))
    return made.select("pair", (F.unix_millis("w.start") - F.lit(horizon_ms)).alias("bucket_ms"), "n_samples", "mae",
                       "without_candle", F.coalesce(F.col("mae") > F.lit(max_mae), F.lit(False)).alias("alarm"))
