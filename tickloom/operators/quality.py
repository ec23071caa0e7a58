"""Expectations, validation summary, column profiles, monitors and alerts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.distribution import cumulative, long_form, quantiles, value_counts
from tickloom.functions.scalars import trading_date, whole_second
from tickloom.functions.series import CELL_ROWS, time_cell
from tickloom.session import materialize

# What a feature table must look like.
REQUIRED_COLUMNS = ("pair", "open", "high", "low", "close", "volume", "window_start_ms",
                    "window_end_ms", "window_in_sec", "sma_7", "ema_7", "rsi_7")
NOT_NULL = ("close", "window_start_ms")
TYPES = {"close": "double", "window_start_ms": "bigint"}
NOT_NEGATIVE = ("close", "volume")
INCREASING = "window_start_ms"
MIN_ROWS = 10

FREQUENT = 1000             # a value is frequent if it holds more than one row in this many


def expectations(df: DataFrame, arrival: str | None = None, strictly: bool = False,
                 min_rows: int = MIN_ROWS, cell: int = CELL_ROWS) -> DataFrame:
    """One row per expectation: name, column, success, unexpected count.

    Counts come from one pass. The time column must increase within each pair in order of
    `arrival`; equal values fail only when `strictly`. Without an arrival column rows have
    no order but their time, so repeats are all that can fail. Arrival numbers are compared in
    cells of `cell` numbers, which bounds the rows of a task group.
    """
    kinds = dict(df.dtypes)
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in NOT_NULL if c in kinds]
    counts += [F.count_if(F.col(c) < 0).alias(f"neg_{c}") for c in NOT_NEGATIVE if c in kinds]
    measured = df.agg(*counts)
    entries: list[tuple[str, str | None, Column, Column]] = []
    none = F.lit(0).cast("bigint")
    entries.append(("row_count_between", None, F.col("rows") >= min_rows, none))
    for c in REQUIRED_COLUMNS:
        entries.append(("column_exists", c, F.lit(c in kinds), none))
    for c in NOT_NULL:
        bad = F.col(f"null_{c}") if c in kinds else none
        entries.append(("not_null", c, (bad == 0) & F.lit(c in kinds), bad))
    for c, kind in TYPES.items():
        entries.append(("of_type", c, F.lit(kinds.get(c) == kind), none))
    for c in NOT_NEGATIVE:
        bad = F.col(f"neg_{c}") if c in kinds else none
        entries.append(("at_least_zero", c, (bad == 0) & F.lit(c in kinds), bad))
    has_order = INCREASING in kinds and "pair" in kinds

    def as_rows(one_row: DataFrame, these) -> DataFrame:
        return one_row.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("expectation"), F.lit(c).cast("string").alias("column"),
                     ok.alias("success"), n.alias("unexpected_count"))
            for name, c, ok, n in these])))

    if not has_order:
        return as_rows(measured, entries + [("increasing", INCREASING, F.lit(False), none)])
    bad = F.col("out_of_order")
    return as_rows(measured, entries).unionByName(as_rows(
        _not_increasing(df, arrival, strictly, cell), [("increasing", INCREASING, bad == 0, bad)]))


def _not_increasing(df: DataFrame, arrival: str | None, strictly: bool, cell: int) -> DataFrame:
    """Rows whose time is below the one before, as a single count.

    Rows are compared inside cells; across cells only one edge value per cell is.
    """
    if arrival is None:
        # In its own order a column fails to increase exactly where a value repeats.
        repeats = df.filter(F.col(INCREASING).isNotNull()).groupBy("pair", INCREASING).agg(
            (F.count(F.lit(1)) - 1 if strictly else F.lit(0)).alias("n"))
        return repeats.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("out_of_order"))
    cells = df.filter(F.col(INCREASING).isNotNull()).withColumn("_cell", time_cell(arrival, cell))
    inside = Window.partitionBy("pair", "_cell").orderBy(arrival)

    def fails(now: str, before: Column) -> Column:
        return (F.col(now) <= before if strictly else F.col(now) < before).alias("bad")

    within = cells.select("pair", "_cell", fails(INCREASING, F.lag(INCREASING).over(inside))).agg(F.count_if("bad").alias("n"))
    along = Window.partitionBy("pair").orderBy("_cell")
    edges = cells.groupBy("pair", "_cell").agg(
        F.min_by(INCREASING, arrival).alias("first"), F.max_by(INCREASING, arrival).alias("last"))
    across = edges.select(fails("first", F.lag("last").over(along))).agg(
        F.count_if("bad").alias("n"))
    return within.unionByName(across).agg(F.sum("n").cast("bigint").alias("out_of_order"))


def validation_summary(results: DataFrame) -> DataFrame:
    """Evaluated, successful and failed expectations, percent, and the overall flag."""
    return results.agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("unsuccessful"),
        (F.count_if("success") * 100.0 / F.count(F.lit(1))).alias("success_percent"),
        F.bool_and("success").alias("success"))


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [c for c, k in df.dtypes
            if k in ("double", "float", "bigint", "int", "smallint", "tinyint")
            and c not in exclude]


def profile(df: DataFrame, columns: list[str] | None = None, by: tuple[str, ...] = ()
            ) -> DataFrame:
    """Per column (and `by` group): count, missing, distinct, mean, std, min, quartiles,
    max, zeros and the most frequent value.

    All exact. Everything comes from one count per distinct value.
    """
    columns = columns or numeric_columns(df, exclude=by)
    by = list(by)
    counted = cumulative(value_counts(long_form(df, columns, by), by), ["n"], by)
    q = quantiles(counted, {"q25": 0.25, "median": 0.5, "q75": 0.75}, by)
    n, v = F.col("n"), F.col("value")
    off = v - F.col("lowest")       # no digits are lost where values are large
    stats = counted.groupBy(*by, "column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("distinct_count"),
        (F.sum(v * n) / F.sum("n")).alias("mean"),
        F.sum(off * off * n).alias("_vv"), F.sum(off * n).alias("_v"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.sum(F.when(v == 0, n).otherwise(F.lit(0))).alias("zeros"),
        F.max_by("value", F.struct(n, -v)).alias("top_value"),
        F.max("n").alias("top_count"))
    spread = (F.col("_vv") - F.col("_v") * F.col("_v") / F.col("count"))
    stats = stats.withColumn("std", F.sqrt(F.try_divide(
        F.greatest(spread, F.lit(0.0)), (F.col("count") - 1).cast("double"))))
    rows = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    sized = rows.select(*by, "_rows", F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
    joined = sized.join(stats, [*by, "column"], "left").join(q, [*by, "column"], "left")
    return joined.select(
        *by, "column",
        F.coalesce("count", F.lit(0)).alias("count"),
        (F.col("_rows") - F.coalesce("count", F.lit(0))).alias("missing"),
        F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
        "mean", "std", "min", "q25", "median", "q75", "max",
        F.coalesce("zeros", F.lit(0)).alias("zeros"), "top_value", "top_count")


def approximate_profile(df: DataFrame, columns: list[str] | None = None,
                        by: tuple[str, ...] = (), accuracy: int = 10_000) -> DataFrame:
    """The profile in one shuffle-light pass, with approximate distinct counts and quartiles."""
    columns = columns or numeric_columns(df, exclude=by)
    values = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(by), columns, "column", "value")
    quarter = F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy)
    return values.groupBy(*by, "column").agg(
        F.count("value").alias("count"), F.count_if(F.col("value").isNull()).alias("missing"),
        F.approx_count_distinct("value").alias("distinct_count"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.get(quarter, 0).alias("q25"),
        F.get(quarter, 1).alias("median"), F.get(quarter, 2).alias("q75"),
        F.max("value").alias("max"), F.count_if(F.col("value") == 0).alias("zeros"))


def ranks(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns with each value's average rank among the values of its column, in no order.

    Ranks come from cumulative counts per distinct value. Values that many rows share are few,
    so their ranks are broadcast; all others are joined by value. Missing values and NaN stay
    missing; rows without any value are left out.
    """
    rows = materialize(df.select(F.monotonically_increasing_id().alias("_row"), *columns))
    each = long_form(rows, columns, ["_row"]).withColumn("value", F.col("value") + F.lit(0.0))
    n = F.col("n")
    placed = materialize(cumulative(value_counts(long_form(rows, columns)), ["n"]).select(
        "column", "value", "n", (F.col("cum_n") - (n - 1) / 2).alias("rank")))
    # At most `FREQUENT` values of a column can have more rows than this.
    often = n > rows.count() / FREQUENT
    first = each.join(F.broadcast(placed.filter(often).drop("n")), ["column", "value"], "left")
    rest = first.filter("rank IS NULL").drop("rank").join(placed.filter(~often).drop("n"), ["column", "value"])
    return first.filter("rank IS NOT NULL").unionByName(rest).groupBy("_row").agg(
        *[F.max(F.when(F.col("column") == c, F.col("rank"))).alias(c) for c in columns]).drop("_row")


def correlations(df: DataFrame, columns: list[str] | None = None, method: str = "pearson") -> DataFrame:
    """Correlation of every two numeric columns: `pearson`, or `spearman` by average ranks.

    A pair counts the rows in which both columns have a value; ranks are those among all values
    of a column. Every task adds up products of its rows, and the sums meet per pair of columns,
    so the plan does not grow with their number. Null where a column does not vary.
    """
    if method not in ("pearson", "spearman"):
        raise ValueError(f"unknown method {method}")
    columns = columns or numeric_columns(df)
    values = ranks(df, columns) if method == "spearman" else df
    doubles = values.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    k = len(columns)
    # Products are taken around the means, so that no digits are lost where values are large.
    centre = np.array([m or 0.0 for m in doubles.agg(*[
        F.avg(F.when(~F.isnan(f"c{i}"), F.col(f"c{i}"))) for i in range(k)]).first()])
    a, b = np.triu_indices(k, 1)
    names = ["n", "x", "y", "xx", "yy", "xy"]

    def products(batches):
        n, x, xx, xy = np.zeros((4, k, k))
        for batch in batches:
            held = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            there = ~np.isnan(held)
            held, there = np.where(there, held - centre, 0.0), there.astype(float)
            n += there.T @ there
            x += held.T @ there
            xx += (held * held).T @ there
            xy += held.T @ held
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (
            a, b, n[a, b], x[a, b], x[b, a], xx[a, b], xx[b, a], xy[a, b])], ["i", "j", *names])

    sums = doubles.mapInArrow(products, "i long, j long, " + ", ".join(f"{c} double" for c in names)).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in names])

    def spread(squares: Column, total: Column) -> Column:
        made = F.col("n") * squares - total * total
        return F.when(made > 1e-12 * F.col("n") * squares, made)

    both = F.sqrt(spread(F.col("xx"), F.col("x"))) * F.sqrt(spread(F.col("yy"), F.col("y")))
    called = F.array(*[F.lit(c) for c in columns])
    pairs = df.sparkSession.range(k * k).select((F.col("id") / k).cast("long").alias("i"), (F.col("id") % k).alias("j")).filter("i < j")
    return pairs.join(F.broadcast(sums), ["i", "j"], "left").select(
        F.get(called, F.col("i").cast("int")).alias("column_a"), F.get(called, F.col("j").cast("int")).alias("column_b"),
        ((F.col("n") * F.col("xy") - F.col("x") * F.col("y")) / both).alias("correlation"))


def consistency_by_day(table: DataFrame, ms: str = "window_start_ms") -> DataFrame:
    """Candle count, first and last candle per pair and day."""
    return table.groupBy("pair", trading_date(ms).alias("trading_date")).agg(
        F.count(F.lit(1)).alias("candle_count"),
        whole_second(F.min(ms)).alias("first_candle"),
        whole_second(F.max(ms)).alias("last_candle"))


def feed_gaps(trades: DataFrame, limit_sec: int = 300) -> DataFrame:
    """Silences longer than `limit_sec` between consecutive trades of a product.

    Trades of one bucket of `limit_sec` lie closer together than that, so the first and
    last trade of each bucket decide. They combine map-side, and the number of buckets
    follows the time covered, not the number of trades.
    """
    limit = limit_sec * 1000
    buckets = trades.groupBy("product_id", time_cell("timestamp_ms", limit).alias("_bucket")).agg(
        F.min("timestamp_ms").alias("next_ms"), F.max("timestamp_ms").alias("_end"))
    along = Window.partitionBy("product_id").orderBy("_bucket")
    silent = F.col("next_ms") - F.col("last_ms")
    return (
        buckets.withColumn("last_ms", F.lag("_end").over(along))
        .filter(silent > limit)
        .select("product_id", "last_ms", "next_ms", (silent / F.lit(1000.0)).alias("gap_sec")))


def stale_feeds(trades: DataFrame, as_of_ms: int, limit_sec: int = 300) -> DataFrame:
    """Last trade of every product and whether the feed is silent for too long."""
    return trades.groupBy("product_id").agg(F.max("timestamp_ms").alias("last_ms")).select(
        "product_id", "last_ms",
        (F.lit(as_of_ms) - F.col("last_ms") > limit_sec * 1000).alias("stale"))


def alerts(stats: DataFrame, gaps: DataFrame, max_duplicate_rate: float = 0.1,
           max_gaps: int = 0) -> DataFrame:
    """Alert rows: duplicate rate of each stream, and number of silences of each product."""
    rate = F.try_divide(F.col("duplicates").cast("double"),
                        (F.col("processed") + F.col("duplicates")).cast("double"))
    high = stats.select(F.lit("duplicate_rate").alias("alert"), F.col("stream").alias("subject"),
                        rate.alias("value"), F.lit(float(max_duplicate_rate)).alias("threshold"))
    silent = gaps.groupBy("product_id").agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("silence").alias("alert"), F.col("product_id").alias("subject"), "value",
        F.lit(float(max_gaps)).alias("threshold"))
    return high.unionByName(silent).filter(F.col("value") > F.col("threshold"))


