"""Exact distribution functions of many columns at once, without one task per column.

Values are first counted per (column, value), which combines map-side. The distinct values
of a column are then cut into ranges of about equal size, and cumulative counts come from
range totals plus a running sum inside each range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.lookups import attach
from tickloom.session import materialize

RANGE_ROWS = 50_000             # distinct values that a range should hold
MOST_RANGES = 8_192             # cut points of a column: 64 KB


def long_form(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """One row per (`by`, column, value), values as double, NULL and NaN dropped."""
    return df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(by), columns, "column", "value").filter(
        F.col("value").isNotNull() & ~F.isnan("value"))


def value_counts(values: DataFrame, by: list[str] = (), sums: dict[str, Column] | None = None
                 ) -> DataFrame:
    """Rows per distinct value; `sums` names counters, default one called n."""
    sums = sums or {"n": F.lit(1)}
    # Adding 0.0 makes -0.0 and 0.0 one value.
    return values.groupBy(*by, "column", (F.col("value") + F.lit(0.0)).alias("value")).agg(
        *[F.sum(c).cast("bigint").alias(n) for n, c in sums.items()])


def cumulative(counts: DataFrame, counters: list[str], by: list[str] = (),
               ranges: int | None = None) -> DataFrame:
    """Add `cum_<counter>` (at or below the value), `all_<counter>`, `next_value` and `lowest`,
    the smallest value of the series.

    The counts are read three times and kept once; their number gives the number of ranges (a
    power of two), unless it is given. The cut points are one short array per
    column, so their size is bounded by the width of the table; with `by` groups it is
    checked.
    """
    series = [*by, "column"]
    counts = materialize(counts)
    if ranges is None:
        ranges = 1 << min(MOST_RANGES.bit_length() - 1, max(4, (counts.count() // RANGE_ROWS).bit_length()))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = counts.groupBy(*series).agg(
        F.array_distinct(F.percentile_approx("value", shares, ranges * 20)).alias("_cuts"))
    tagged = attach(counts, cuts, series, "inner", row_bytes=16 * ranges) if by else counts.join(F.broadcast(cuts), series)
    halves = F.array(*[F.lit(ranges >> i) for i in range(1, ranges.bit_length())])

    def closer(spot: Column, half: Column) -> Column:
        """Halving search for the number of cuts at or below the value."""
        fits = (spot + half <= F.size("_cuts")) & (F.get("_cuts", spot + half - 1) <= F.col("value"))
        return F.when(fits, spot + half).otherwise(spot)

    tagged = tagged.withColumn("_range", F.aggregate(halves, F.lit(0), closer)).drop("_cuts")
    along = Window.partitionBy(*series).orderBy("_range")
    totals = (
        tagged.groupBy(*series, "_range")
        .agg(*[F.sum(c).alias(f"_t_{c}") for c in counters], F.min("value").alias("_low"))
        .select(*series, "_range", F.lead("_low").over(along).alias("_after"),
                F.min("_low").over(Window.partitionBy(*series)).alias("lowest"),
                *[(F.sum(f"_t_{c}").over(along) - F.col(f"_t_{c}")).alias(f"_before_{c}")
                  for c in counters],
                *[F.sum(f"_t_{c}").over(Window.partitionBy(*series)).alias(f"all_{c}")
                  for c in counters]))
    inside = Window.partitionBy(*series, "_range").orderBy("value")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        tagged.select("*", F.lead("value").over(inside).alias("_lead"),
                      *[F.sum(c).over(running).alias(f"_run_{c}") for c in counters])
        .join(totals, [*series, "_range"])
        .select(*series, "value", *counters,
                *[(F.col(f"_run_{c}") + F.col(f"_before_{c}")).alias(f"cum_{c}") for c in counters],
                *[F.col(f"all_{c}") for c in counters],
                F.coalesce("_lead", "_after").alias("next_value"), "lowest"))


def quantiles(cumulated: DataFrame, shares: dict[str, float], by: list[str] = (),
              counter: str = "n") -> DataFrame:
    """Exact quantiles with linear interpolation, one row per column.

    The neighbours of position q*(n-1) are the values whose cumulative counts enclose it.
    """
    total, upto = F.col(f"all_{counter}"), F.col(f"cum_{counter}")
    below = upto - F.col(counter)
    aggs = []
    for name, q in shares.items():
        spot = F.lit(q) * (total - 1)
        low, high = F.floor(spot), F.ceil(spot)
        at_low = F.max(F.when((below <= low) & (low < upto), F.col("value")))
        at_high = F.max(F.when((below <= high) & (high < upto), F.col("value")))
        part = F.max(spot - low)
        aggs.append((at_low + (at_high - at_low) * part).alias(name))
    return cumulated.groupBy(*by, "column").agg(*aggs)
