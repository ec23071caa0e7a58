"""Ordered-series primitives that never put one whole series into one task.

A market feed has few, very long series, so a window over the series key alone would
leave most of a cluster idle. The functions here cut each series into bounded parts:

* `number_rows`    position of every row in its series, from counts per time cell;
* `with_halo`      equal blocks of positions plus the neighbouring rows each block needs;
* `nearest_known`  closest earlier or later non-null value, carried over cells;
* `affine_scan`    y[t] = a*y[t-1] + u[t] over a whole series.

Series keys and order columns must not be NULL; the decoders see to that.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

CELL_ROWS = 4096    # candles per time cell: the bound of one numbering task group
BLOCK_ROWS = 8192   # rows per halo block
SCAN_ROWS = 256     # rows per scan block


def time_cell(ms: str, width_ms: int) -> Column:
    """Coarse cell of a time column; monotone, so cells can be ordered."""
    return F.expr(f"`{ms}` div {int(width_ms)}L")


def candle_cell(step_ms: int, ms: str = "window_start_ms") -> Column:
    """Cell holding at most CELL_ROWS candles of one pair."""
    return time_cell(ms, step_ms * CELL_ROWS)


def number_rows(df: DataFrame, keys: list[str], order: list[str], cell: Column,
                position: str = "rn", total: str | None = None) -> DataFrame:
    """Add the 1-based position of each row in its series, and the series length.

    Rows are numbered inside (key, cell); only one count per cell is summed up along a
    series. Counting and numbering share the partitioning by (key, cell), so the rows are
    shuffled once.
    """
    tagged = df.withColumn("_cell", cell)
    along = Window.partitionBy(*keys).orderBy("_cell")
    offsets = (
        tagged.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, "_cell",
                (F.sum("_rows").over(along) - F.col("_rows")).alias("_before"),
                F.sum("_rows").over(Window.partitionBy(*keys)).alias("_total"))
    )
    local = F.row_number().over(Window.partitionBy(*keys, "_cell").orderBy(*order))
    numbered = (
        tagged.withColumn("_local", local)
        .join(offsets, [*keys, "_cell"])
        .withColumn(position, F.col("_before") + F.col("_local"))
    )
    if total:
        numbered = numbered.withColumn(total, F.col("_total"))
    return numbered.drop("_cell", "_local", "_before", "_total")


def with_halo(df: DataFrame, keys: list[str], before: int = 0, after: int = 0,
              position: str = "rn", block_rows: int | None = None) -> tuple[DataFrame, Window]:
    """Copy each row into the blocks that look at it, and give the window over a block.

    `before` and `after` are the largest distances a window function looks back or ahead.
    Copies carry `_halo` = true; call `drop_halo` when the window columns are in place.
    """
    block_rows = block_rows or BLOCK_ROWS
    at = F.col(position) - 1
    home = F.expr(f"({position} - 1) div {block_rows}")
    first = F.expr(f"greatest({position} - 1 - {after}, 0) div {block_rows}")
    last = F.expr(f"({position} - 1 + {before}) div {block_rows}")
    copied = (
        df.withColumn("_block", F.explode(F.sequence(first, last)))
        .withColumn("_halo", F.col("_block") != home)
    )
    return copied, Window.partitionBy(*keys, "_block").orderBy(at)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("_halo")).drop("_block", "_halo")


def nearest_known(df: DataFrame, keys: list[str], order: str, cell: Column,
                  columns: list[str], later: bool = False, at: str | None = None) -> DataFrame:
    """Add the closest known value at or before each row (`later`: at or after).

    New columns are `_prev_<c>` and, when `at` names a time column, `_prev_at_<c>`
    (`_next_...` when `later`). `order` must be unique within a series. A `_cell` column
    that is there already is used and kept, so two calls share one shuffle.
    """
    name = "_next" if later else "_prev"
    pick = F.min_by if later else F.max_by
    edge = F.min if later else F.max

    def ordered(c):
        return F.col(c).desc() if later else F.col(c).asc()

    def known(c):
        return F.col(c).isNotNull()

    tagged = df if "_cell" in df.columns else df.withColumn("_cell", cell)
    picks = []
    for c in columns:
        picks.append(pick(c, F.when(known(c), F.col(order))).alias(f"_edge_{c}"))
        if at:
            picks.append(edge(F.when(known(c), F.col(at))).alias(f"_edge_at_{c}"))
    over_cells = Window.partitionBy(*keys).orderBy(ordered("_cell")).rowsBetween(
        Window.unboundedPreceding, -1)
    names = [f"{kind}{c}" for c in columns for kind in (["", "at_"] if at else [""])]
    carried = tagged.groupBy(*keys, "_cell").agg(*picks).select(
        *keys, "_cell",
        *[F.last(f"_edge_{n}", ignorenulls=True).over(over_cells).alias(f"_carry_{n}")
          for n in names])
    in_cell = Window.partitionBy(*keys, "_cell").orderBy(ordered(order)).rowsBetween(
        Window.unboundedPreceding, 0)
    local = []
    for c in columns:
        local.append(F.last(c, ignorenulls=True).over(in_cell).alias(f"_here_{c}"))
        if at:
            local.append(F.last(F.when(known(c), F.col(at)), ignorenulls=True)
                         .over(in_cell).alias(f"_here_at_{c}"))
    joined = tagged.select("*", *local).join(carried, [*keys, "_cell"])
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[F.coalesce(F.col(f"_here_{n}"), F.col(f"_carry_{n}")).alias(f"{name}_{n}")
          for n in names])


def scan_rows(decays: list[float], longest_need: int) -> int:
    """Rows per scan block: covers `longest_need`, and keeps a**-rows in range."""
    rows = max(SCAN_ROWS, longest_need)
    steepest = min((a for a in decays if 0 < a < 1), default=1.0)
    if -math.log(steepest) * rows > 650:
        raise ValueError("periods too far apart for one scan; compute them separately")
    return rows


def _look_back(shrink: float) -> int:
    """Groups until an older value has shrunk below double precision."""
    terms = 1 if shrink < 1e-18 else math.ceil(math.log(1e-18) / math.log(shrink))
    if terms > 100:
        raise ValueError("smoothing too slow for one scan; use larger scan blocks")
    return terms


def affine_scan(df: DataFrame, keys: list[str], steps: dict[str, tuple[float, str]],
                position: str = "rn", rows: int = SCAN_ROWS) -> DataFrame:
    """Add y[t] = a*y[t-1] + u[t] for every entry `name: (a, u)`, with y = 0 before row 1.

    Three levels: a weighted sum per block of `rows` rows, a fold over 256 blocks, and a
    look back over those folds that is as long as double precision needs. Then each block finishes on its own from the value
    carried in. No level holds more than 256 values of a series in one place. `u` is SQL
    text, which keeps a plan with dozens of smoothers quick to build.
    """
    group = 256
    by = ", ".join(f"`{k}`" for k in keys)
    number = {n: i for i, n in enumerate(steps)}
    inputs = df.selectExpr(
        "*", f"({position} - 1) div {rows} AS _scan", f"({position} - 1) % {rows} AS _spot",
        *[f"CAST({u} AS DOUBLE) AS _u{number[n]}" for n, (_, u) in steps.items()])

    blocks = inputs.groupBy(*keys, "_scan").agg(*[
        F.expr(f"sum(_u{number[n]} * pow({a!r}D, {rows - 1} - _spot)) AS _s{number[n]}")
        for n, (a, _) in steps.items()])
    folded = (
        blocks.groupBy(*keys, F.expr(f"_scan div {group} AS _group"))
        .agg(F.array_sort(F.collect_list(F.struct("_scan", *[f"_s{i}" for i in number.values()])))
             .alias("_parts")))
    folded = folded.selectExpr("*", *[
        f"aggregate(_parts, 0D, (y, b) -> y * {a ** rows!r}D + b._s{number[n]}) AS _t{number[n]}"
        for n, (a, _) in steps.items()])
    carries = []
    for n, (a, _) in steps.items():
        t, along = f"_t{number[n]}", f"OVER (PARTITION BY {by} ORDER BY _group"
        if a == 1:
            carry = f"sum({t}) {along} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        else:
            # A whole group shrinks an older value by a**(256*rows), so few groups still count.
            shrink = a ** (rows * group)
            carry = " + ".join(f"coalesce(lag({t}, {back}) {along}), 0D) * {shrink ** (back - 1)!r}D"
                               for back in range(1, _look_back(shrink) + 1))
        carries.append(f"coalesce({carry}, 0D) AS _c{number[n]}")
    entering = [
        f"aggregate(_parts, array(_c{number[n]}), (y, b) -> concat(y, array("
        f"element_at(y, -1) * {a ** rows!r}D + b._s{number[n]}))) AS _c{number[n]}"
        for n, (a, _) in steps.items()]
    # The folds are columns before the arrays open up, so each runs once per group.
    columns = ", ".join(["_scan", *[f"_c{i}" for i in number.values()]])
    carried = (
        folded.selectExpr(*keys, "_group", "_parts", *carries)
        .selectExpr(*keys, "_parts._scan AS _scan", *entering)
        .selectExpr(*keys, f"inline(arrays_zip({columns}))").filter("_scan IS NOT NULL"))

    inside = f"OVER (PARTITION BY {by}, _scan ORDER BY {position} ROWS UNBOUNDED PRECEDING)"
    local = inputs.selectExpr("*", *[
        f"_u{number[n]} AS _l{number[n]}" if a == 0 else
        f"sum(_u{number[n]} * pow({a!r}D, -_spot)) {inside} * pow({a!r}D, _spot) AS _l{number[n]}"
        for n, (a, _) in steps.items()])
    return local.join(carried, [*keys, "_scan"]).selectExpr(
        *df.columns,
        *[f"_l{number[n]} + _c{number[n]} * pow({a!r}D, _spot + 1) AS `{n}`"
          for n, (a, _) in steps.items()])
