"""Stored trades and the keyed feature table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.operators.dedup import KEYS, one_per_key
from tickloom.sources import versions

DAY_MS = 86_400_000


def trades_since(trades: DataFrame, as_of_ms: int, last_n_days: int) -> DataFrame:
    """Trades no older than `last_n_days` before `as_of_ms`."""
    return trades.filter(F.col("timestamp_ms") >= as_of_ms - last_n_days * DAY_MS)


def backfill_progress(trades: DataFrame, last_n_days: int) -> DataFrame:
    """Trades, days covered and percent of the target, per product."""
    spans = trades.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("trades"), F.min("timestamp_ms").alias("first_ms"),
        F.max("timestamp_ms").alias("last_ms"))
    days = (F.col("last_ms") - F.col("first_ms")) / F.lit(float(DAY_MS))
    return spans.withColumn("days_covered", days).withColumn(
        "percent", F.least(F.lit(100.0), F.col("days_covered") / F.lit(float(last_n_days)) * 100.0))


def read_partitions(spark: SparkSession, path: str, partitions: list[list], schema: dict) -> DataFrame:
    """The current rows of the listed partitions, with `month`.

    Partitions of one folder hold each key once and are read as they are; only those of several
    folders are compared by key, the newest folder first.
    """
    kinds = T.StructType.fromJson(schema)
    files = T.StructType([*kinds.fields, T.StructField("run", T.IntegerType()), T.StructField("batch_id", T.LongType())])

    def rows(some: list[list]) -> DataFrame:
        paths = [versions.partition_path(spark, path, f, p, m) for p, m, folders in some for f in folders]
        found = spark.read.option("basePath", path).schema(files).parquet(*paths) if paths else spark.createDataFrame([], files)
        return found.select(*files.names)

    whole = rows([p for p in partitions if len(p[2]) == 1]).drop("run", "batch_id")
    several = [p for p in partitions if len(p[2]) > 1]
    if not several:
        return whole
    return whole.unionByName(one_per_key(rows(several), KEYS["candles"], [F.desc("run"), F.desc("batch_id")]).drop("run", "batch_id"))


def read_feature_table(spark: SparkSession, path: str, pair: str | None = None,
                       from_ms: int | None = None) -> DataFrame:
    """The current rows of the feature table at `path` (see sinks.tables.upsert).

    The newest version lists the folders of each pair and month; the filters choose among
    them before any folder is listed.
    """
    path = path.rstrip("/")
    state = versions.read(spark, path)
    if state is None:
        raise FileNotFoundError(f"no feature table at {path}")
    chosen = state["partitions"]
    if pair is not None:
        chosen = [p for p in chosen if p[0] == pair]
    if from_ms is not None:
        day = datetime.fromtimestamp(from_ms / 1000, timezone.utc)
        chosen = [p for p in chosen if p[1] >= day.year * 100 + day.month]
    table = read_partitions(spark, path, chosen, state["schema"]).drop("month")
    return table if from_ms is None else table.filter(F.col("window_start_ms") >= from_ms)
