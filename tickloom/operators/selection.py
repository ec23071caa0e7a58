"""Reading a feature table: newest rows, ranges, panels, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.scalars import event_time, whole_second

TIME = "window_start_ms"
DAY_MS = 86_400_000


def distinct_pairs(table: DataFrame) -> DataFrame:
    return table.select("pair").distinct()


def latest_rows(table: DataFrame, pair: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows newest first, of one pair and up to `limit`, with a readable time."""
    rows = table if pair is None else table.filter(F.col("pair") == pair)
    rows = rows.orderBy(F.desc(TIME), F.asc("pair"))
    rows = rows if limit is None else rows.limit(limit)
    return rows.withColumn("timestamp", event_time(TIME))


def pair_last_days(table: DataFrame, pair: str, days: int, as_of_ms: int) -> DataFrame:
    """Rows of one pair that start after `as_of_ms` minus `days`, oldest first."""
    return (
        table.filter((F.col("pair") == pair) & (F.col(TIME) > as_of_ms - days * DAY_MS))
        .orderBy(TIME)
        .withColumn("timestamp", event_time(TIME)))


def training_horizon(table: DataFrame, days: int | None, as_of_ms: int) -> DataFrame:
    """Rows at or after `as_of_ms` minus `days`; everything when days is None or <= 0."""
    if days is None or days <= 0:
        return table
    return table.filter(F.col(TIME) >= as_of_ms - days * DAY_MS)


def newest_per_pair(table: DataFrame, n: int = 100) -> DataFrame:
    """The newest n rows of every pair; Spark keeps n per pair and map task before the
    shuffle."""
    rank = F.row_number().over(Window.partitionBy("pair").orderBy(F.desc(TIME)))
    return table.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def sample_check(table: DataFrame, limit: int = 20) -> DataFrame:
    """Key columns with a readable time, by pair and newest first."""
    return (
        table.orderBy(F.asc("pair"), F.desc(TIME)).limit(limit)
        .select("pair", TIME, "window_end_ms", "created_at",
                whole_second(TIME).alias("window_start_time")))


def _between(table: DataFrame, pairs: list[str] | None, from_ms: int | None,
             to_ms: int | None) -> DataFrame:
    conditions: list[Column] = []
    if pairs:
        conditions.append(F.col("pair").isin(*pairs))
    if from_ms is not None:
        conditions.append(F.col(TIME) >= from_ms)
    if to_ms is not None:
        conditions.append(F.col(TIME) <= to_ms)
    for c in conditions:
        table = table.filter(c)
    return table


def price_panel(table: DataFrame, pairs: list[str] | None = None, from_ms: int | None = None,
                to_ms: int | None = None) -> DataFrame:
    """OHLC over time for a price chart."""
    return _between(table, pairs, from_ms, to_ms).select(
        "pair", whole_second(TIME).alias("time"), "open", "high", "low", "close")


def indicator_panel(table: DataFrame, columns: list[str], pairs: list[str] | None = None,
                    from_ms: int | None = None, to_ms: int | None = None) -> DataFrame:
    """Chosen indicator columns over time for a chart."""
    return _between(table, pairs, from_ms, to_ms).select(
        "pair", whole_second(TIME).alias("time"), *columns)


def only_models(table: DataFrame, top: DataFrame, on: tuple[str, ...] = ("pair", "model")
                ) -> DataFrame:
    """Rows whose model is in the top list."""
    return table.join(top.select(*on).distinct(), list(on), "left_semi")


def align_target(features: DataFrame, target: DataFrame,
                 on: tuple[str, ...] = ("pair", TIME)) -> DataFrame:
    """Put a separate target beside its feature rows by key."""
    return features.join(target, list(on))
