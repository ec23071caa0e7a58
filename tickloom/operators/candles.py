"""OHLCV candles: from trades, from smaller candles, and across empty windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.scalars import window_start
from tickloom.functions.series import candle_cell, drop_halo, number_rows, with_halo

COLUMNS = ["pair", "open", "high", "low", "close", "volume",
           "window_start_ms", "window_end_ms", "window_in_sec"]


def trade_order(open_close_by: str, arrival: str | None) -> Column:
    """What "first" and "last" trade of a window mean.

    "arrival" follows the arrival number, as a consumer of the feed sees it; one long
    column keeps the aggregation in hash form. "event_time" sorts by trade time and breaks
    ties by arrival.
    """
    if open_close_by == "arrival" and arrival:
        return F.col(arrival)
    if open_close_by == "event_time" and arrival:
        return F.struct("timestamp_ms", arrival)
    if arrival is None:
        return F.col("timestamp_ms")
    raise ValueError(f"unknown open_close_by: {open_close_by}")


def ohlcv(order: Column) -> list[Column]:
    """The five aggregates of a candle; all of them combine map-side.

    Trades without a price do not open or close a candle; without any price all four are NULL.
    """
    order = F.when(F.col("price").isNotNull(), order)
    return [
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("quantity").alias("volume"),
    ]


def candles(trades: DataFrame, window_in_sec: int, arrival: str | None = "seq",
            open_close_by: str = "arrival", extra: list[Column] = ()) -> DataFrame:
    """Candles over epoch-aligned tumbling windows; a window without trades has no row.

    `extra` adds named aggregates of one's own, such as a trade count.
    """
    width = window_in_sec * 1000
    made = (
        trades.groupBy(F.col("product_id").alias("pair"),
                       window_start("timestamp_ms", width).alias("window_start_ms"))
        .agg(*ohlcv(trade_order(open_close_by, arrival)), *extra)
        .withColumn("window_end_ms", F.col("window_start_ms") + F.lit(width))
        .withColumn("window_in_sec", F.lit(window_in_sec))
    )
    return made.select(*COLUMNS, *[c for c in made.columns if c not in COLUMNS])


def only_resolution(candle_rows: DataFrame, window_in_sec: int) -> DataFrame:
    """Keep the candles of one size."""
    return candle_rows.filter(F.col("window_in_sec") == window_in_sec)


def roll_up(candle_rows: DataFrame, window_in_sec: int) -> DataFrame:
    """Larger candles out of smaller ones; equals building them from the trades."""
    width = window_in_sec * 1000
    return (
        candle_rows.groupBy("pair", window_start("window_start_ms", width).alias("_start"))
        .agg(F.min_by("open", F.when(F.col("open").isNotNull(), F.col("window_start_ms"))).alias("open"),
             F.max("high").alias("high"),
             F.min("low").alias("low"),
             F.max_by("close", F.when(F.col("close").isNotNull(), F.col("window_start_ms"))).alias("close"),
             F.sum("volume").alias("volume"))
        .withColumn("window_start_ms", F.col("_start"))
        .withColumn("window_end_ms", F.col("_start") + F.lit(width))
        .withColumn("window_in_sec", F.lit(window_in_sec))
        .select(*COLUMNS)
    )


def fill_gaps(candle_rows: DataFrame, window_in_sec: int) -> DataFrame:
    """Add a flat candle with volume 0 for each empty window between two candles.

    Each candle generates the missing windows after itself, so neither a calendar table
    nor a join is needed.
    """
    step = window_in_sec * 1000
    numbered = number_rows(candle_rows, ["pair"], ["window_start_ms"], candle_cell(step))
    ahead, w = with_halo(numbered, ["pair"], after=1)
    spread = drop_halo(ahead.withColumn("_next", F.lead("window_start_ms").over(w))).select(
        *COLUMNS,
        F.explode(F.when(
            F.col("_next").isNull(), F.array("window_start_ms")
        ).otherwise(F.sequence(F.col("window_start_ms"), F.col("_next") - F.lit(step),
                               F.lit(step).cast("bigint")))).alias("_start"))
    real = F.col("_start") == F.col("window_start_ms")
    return spread.select(
        "pair",
        *[F.when(real, F.col(c)).otherwise(F.col("close")).alias(c) for c in ("open", "high", "low")],
        "close",
        F.when(real, F.col("volume")).otherwise(F.lit(0.0)).alias("volume"),
        F.col("_start").alias("window_start_ms"),
        (F.col("_start") + F.lit(step)).alias("window_end_ms"),
        "window_in_sec",
        (~real).alias("filled"))
