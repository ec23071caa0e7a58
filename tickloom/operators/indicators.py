"""Technical indicators on candles.

Two modes. `seed="tail"` gives what a streaming evaluation of the last bar returns: each
value depends on a fixed number of candles, so the EMA is its own seed (the SMA), RSI is
un-smoothed and OBV is the current volume. `seed="full"` runs the smoothing along the whole
series. Columns stay NULL until the candles an indicator needs are there.

An unknown price (NULL or NaN) makes every tail indicator NULL whose candles include it, an
unknown volume that candle's OBV. In full mode a candle with an unknown price or volume has no
indicators, and everything starts anew after it: what follows is a series of its own, whose
candles are counted from there.

Needs, in candles: SMA and EMA p, RSI p+1, ADX 2p, MACD 3p-1 (fast p, slow 2p, signal p).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F, types as T

from tickloom.functions.scalars import present
from tickloom.functions.series import (
    CELL_ROWS, affine_scan, candle_cell, drop_halo, nearest_known, number_rows, scan_rows, with_halo)
from tickloom.session import materialize
from tickloom.schemas import INDICATOR_KINDS, PERIODS, feature_schema, indicator_columns


def needs(p: int) -> dict[str, int]:
    return {"sma": p, "ema": p, "rsi": p + 1, "adx": 2 * p,
            "macd": 3 * p - 1, "macdsignal": 3 * p - 1, "macdhist": 3 * p - 1}


def macd_weights(p: int) -> tuple[list[float], list[float]]:
    """Tail MACD line and signal as weights on the last 3p-1 closes, oldest first.

    Both averages start p-1 bars before the current one, from the plain mean of the closes
    up to that bar.
    """
    size = 3 * p - 1

    def ema_points(n: int) -> list[list[float]]:
        k = 2.0 / (n + 1)
        start = 2 * p
        point = [1.0 / n if start - n <= j < start else 0.0 for j in range(size)]
        points = [point]
        for step in range(1, p):
            point = [(1 - k) * w for w in point]
            point[start + step - 1] += k
            points.append(point)
        return points

    fast, slow = ema_points(p), ema_points(2 * p)
    line = [f - s for f, s in zip(fast[-1], slow[-1])]
    signal = [sum(f[j] - s[j] for f, s in zip(fast, slow)) / p for j in range(size)]
    return line, signal


def tail_arrays(high: np.ndarray, low: np.ndarray, close: np.ndarray, volume: np.ndarray,
                periods, kinds=INDICATOR_KINDS) -> dict[str, np.ndarray]:
    """Tail-mode indicators of consecutive candles of one pair; NaN where too few precede.

    ADX: true range cancels in the ratio, so with net = plus - minus and gross = plus +
    minus movement, smoothed alike, DX = 100*abs(net)/gross, and 0 while nothing moves.
    """
    n = len(close)
    change, rise, fall = np.diff(close), np.diff(high), -np.diff(low)
    gain, moved = np.clip(change, 0, None), np.abs(change)
    net = np.where((rise > fall) & (rise > 0), rise, 0.0) - np.where(
        (fall > rise) & (fall > 0), fall, 0.0)
    net[np.isnan(rise) | np.isnan(fall)] = np.nan
    gross = np.abs(net)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.divide(100 * part, whole, out=np.where(np.isnan(whole), whole, 0.0), where=whole > 0)

    out = {}

    def put(name: str, need: int, make) -> None:
        column = np.full(n, np.nan)
        if n >= need:
            column[need - 1:] = make()
        out[name] = column

    for p in periods:
        if "sma" in kinds or "ema" in kinds:
            put(f"sma_{p}", p, lambda: sliding_window_view(close, p).mean(axis=1))
            out[f"ema_{p}"] = out[f"sma_{p}"]
        if "rsi" in kinds:
            put(f"rsi_{p}", p + 1, lambda: share(sliding_window_view(gain, p).sum(axis=1),
                                                 sliding_window_view(moved, p).sum(axis=1)))
        if "adx" in kinds:
            def adx() -> np.ndarray:
                bars = n - 2 * p + 1
                if p > 1:
                    d = sliding_window_view(net, p - 1).sum(axis=1)[:bars]
                    g = sliding_window_view(gross, p - 1).sum(axis=1)[:bars]
                else:
                    d, g = np.zeros(bars), np.zeros(bars)
                total = np.zeros(bars)
                for step in range(p - 1, 2 * p - 1):
                    d = d * (p - 1) / p + net[step:step + bars]
                    g = g * (p - 1) / p + gross[step:step + bars]
                    total += share(np.abs(d), g)
                return total / p
            put(f"adx_{p}", 2 * p, adx)
        if {"macd", "macdsignal", "macdhist"} & set(kinds):
            line, signal = (np.array(w) for w in macd_weights(p))
            put(f"macd_{p}", 3 * p - 1, lambda: np.correlate(close, line))
            put(f"macdsignal_{p}", 3 * p - 1, lambda: np.correlate(close, signal))
            out[f"macdhist_{p}"] = out[f"macd_{p}"] - out[f"macdsignal_{p}"]
    out["obv"] = volume
    return out


def _tail(df: DataFrame, keys: list[str], periods, kinds) -> DataFrame:
    """Tail mode: one pass over blocks of candles, each with the history it needs.

    Spark recomputes a sliding frame for every row, which costs the sum of all periods per
    row and indicator. Array arithmetic inside a block of bounded size is far cheaper
    """
    look_back = max([1] + [need - 1 for p in periods for k, need in needs(p).items() if k in kinds])
    rows, _ = with_halo(df, keys, before=look_back)
    made = [c for c in indicator_columns(periods) if c.partition("_")[0] in (*kinds, "obv")]
    schema = T.StructType(df.schema.fields + [T.StructField(c, T.DoubleType()) for c in made])
    names = df.columns

    def block(rows_of_block: pa.Table) -> pa.Table:
        order = np.argsort(rows_of_block["rn"].to_numpy())
        prices = (rows_of_block[c].to_numpy()[order] for c in ("high", "low", "close", "volume"))
        arrays = tail_arrays(*prices, periods, kinds)
        home = ~rows_of_block["_halo"].to_numpy()[order]
        out = rows_of_block.select(names).take(order[home])
        for c in made:
            out = out.append_column(c, pa.array(arrays[c][home], from_pandas=True))
        return out

    return rows.groupBy(*keys, "_block").applyInArrow(block, schema)


def _smooth(start: int, seed: str, later: str) -> str:
    """Input of a scan whose value at row `start` is `seed`."""
    return f"CASE WHEN rn = {start} THEN {seed} WHEN rn > {start} THEN {later} ELSE 0D END"


def _mean(column: str, first: int, count: int, over: str) -> str:
    """Mean over rows first..first+count-1, to be read at the last of them."""
    last = first + count - 1
    return f"sum(CASE WHEN rn BETWEEN {first} AND {last} THEN {column} END) {over} / {count}D"


def _full(df: DataFrame, keys: list[str], periods, kinds) -> DataFrame:
    """Full mode: seeds from the first rows of a series, then two rounds of scans.

    The first round holds the averages of prices and movements, the second one what is
    smoothed again (MACD signal, ADX). A scan reads its input twice, so that is kept once.
    """
    by = ", ".join(f"`{k}`" for k in keys)
    macd = bool({"macd", "macdsignal", "macdhist"} & set(kinds))
    look_back = max([1] + [p - 1 for p in periods if "sma" in kinds])
    rows, _ = with_halo(df, keys, before=look_back)
    ordered = f"PARTITION BY {by}, _block ORDER BY rn"
    so_far = f"OVER ({ordered} ROWS UNBOUNDED PRECEDING)"
    rows = rows.selectExpr(
        "*", *[f"{c} - lag({c}) OVER ({ordered}) AS _d_{c}" for c in ("close", "high", "low")]
    ).selectExpr(
        "*", "greatest(_d_close, 0D) AS _up", "greatest(-_d_close, 0D) AS _down",
        "CASE WHEN _d_high > -_d_low AND _d_high > 0 THEN _d_high ELSE 0D END AS _plus",
        "CASE WHEN -_d_low > _d_high AND _d_low < 0 THEN -_d_low ELSE 0D END AS _minus")

    seeds, first, second, middle, last = [], {}, {}, [], []
    first["obv"] = (1.0, "CASE WHEN rn = 1 THEN volume ELSE signum(_d_close) * volume END")
    for p in periods:
        k, k2, wilder = 2.0 / (p + 1), 2.0 / (2 * p + 1), (p - 1) / p
        if "sma" in kinds:
            seeds.append(f"avg(close) OVER ({ordered} ROWS {p - 1} PRECEDING) AS sma_{p}")
        if "ema" in kinds:
            seeds.append(f"{_mean('close', 1, p, so_far)} AS _m_{p}")
            first[f"ema_{p}"] = (1 - k, _smooth(p, f"_m_{p}", f"close * {k!r}D"))
        if macd:
            seeds.append(f"{_mean('close', p + 1, p, so_far)} AS _mf_{p}")
            seeds.append(f"{_mean('close', 1, 2 * p, so_far)} AS _ms_{p}")
            first[f"_fast_{p}"] = (1 - k, _smooth(2 * p, f"_mf_{p}", f"close * {k!r}D"))
            first[f"_slow_{p}"] = (1 - k2, _smooth(2 * p, f"_ms_{p}", f"close * {k2!r}D"))
            middle.append((f"_line_{p}", f"_fast_{p} - _slow_{p}"))
            second[f"macdsignal_{p}"] = (1 - k, 3 * p - 1, f"_line_{p}", 2 * p, k)
            last += [f"_line_{p} AS macd_{p}", f"_line_{p} - macdsignal_{p} AS macdhist_{p}"]
        if "rsi" in kinds:
            for side in ("up", "down"):
                seeds.append(f"{_mean('_' + side, 2, p, so_far)} AS _m{side}_{p}")
                first[f"_{side}_{p}"] = (wilder, _smooth(p + 1, f"_m{side}_{p}", f"_{side} / {p}"))
            moved = f"(_up_{p} + _down_{p})"
            last.append(f"CASE WHEN {moved} > 0 THEN 100 * _up_{p} / {moved} ELSE 0D END AS rsi_{p}")
        if "adx" in kinds:
            for side in ("plus", "minus"):
                seeds.append(f"{_mean('_' + side, 2, p - 1, so_far)} * {p - 1} AS _m{side}_{p}"
                             if p > 1 else f"0D AS _m{side}_{p}")
                first[f"_{side}_{p}"] = (wilder, _smooth(p, f"_m{side}_{p}", f"_{side}"))
            gross = f"(_plus_{p} + _minus_{p})"
            middle.append((f"_dx_{p}", f"CASE WHEN {gross} > 0 THEN 100 * abs(_plus_{p} - _minus_{p})"
                                       f" / {gross} ELSE 0D END"))
            second[f"adx_{p}"] = (wilder, 2 * p, f"_dx_{p}", p + 1, 1 / p)
    size = scan_rows([a for a, _ in first.values()], max(3 * p for p in periods))
    made = affine_scan(materialize(drop_halo(rows.selectExpr("*", *seeds))), keys, first, rows=size)
    if second:
        block = f"OVER (PARTITION BY {by}, (rn - 1) div {size} ORDER BY rn ROWS UNBOUNDED PRECEDING)"
        made = made.selectExpr("*", *[f"{e} AS {n}" for n, e in middle])
        made = made.selectExpr("*", *[
            f"{_mean(column, since, start - since + 1, block)} AS _seed_{n}"
            for n, (_, start, column, since, _) in second.items()])
        made = affine_scan(materialize(made), keys, {
            n: (a, _smooth(start, f"_seed_{n}", f"{column} * {weight!r}D"))
            for n, (a, start, column, _, weight) in second.items()}, rows=size)
    return made.selectExpr("*", *last)


def _full_in_runs(df: DataFrame, keys: list[str], periods, kinds) -> DataFrame:
    """Full mode over runs of known candles; `_rn` keeps the position in the whole series.

    The candles are stored once; where none is unknown, a series is one run.
    """
    df = materialize(df.withColumns({c: present(c) for c in PRICES}).withColumn("_rn", F.col("rn")))
    unknown = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in PRICES])
    if df.filter(unknown).isEmpty():
        return _full(df, keys, periods, kinds)
    cell = F.expr(f"rn div {CELL_ROWS}L")
    marked = nearest_known(df.withColumn("_hole", F.when(unknown, F.col("rn"))), keys, "rn", cell, ["_hole"])
    run = F.coalesce("_prev__hole", F.lit(0).cast("bigint"))
    known = marked.filter(~unknown).withColumns({"_run": run, "rn": F.col("rn") - run}).drop("_hole", "_prev__hole")
    made = _full(known, [*keys, "_run"], periods, kinds)
    # A position of 0 is before the need of every indicator.
    return made.unionByName(df.filter(unknown).withColumn("rn", F.lit(0).cast("bigint")), allowMissingColumns=True)


PRICES = ("high", "low", "close", "volume")


def indicators(candle_rows: DataFrame, periods=PERIODS, seed: str = "tail",
               max_history: int | None = None, kinds: tuple[str, ...] | None = None,
               keys: tuple[str, ...] = ("pair",), step_ms: int = 60_000,
               numbered: bool = False) -> DataFrame:
    """Candle columns plus the indicators of every period and the OBV.

    One row per candle window is expected (see `dedup`). `max_history` blanks the
    indicators that need more candles than a consumer with that much state could hold.
    `kinds` restricts the work to some indicators. `step_ms` is the candle size; it
    only sets how finely the row numbering is spread. With `numbered`, the input carries
    `rn` already, and it is kept.
    """
    keys = list(keys)
    kinds = tuple(kinds or INDICATOR_KINDS)
    df = candle_rows if numbered else number_rows(
        candle_rows, keys, ["window_start_ms"], candle_cell(step_ms))
    if seed == "tail":
        made = _tail(df, keys, periods, kinds).withColumn("_rn", F.col("rn"))
    else:
        made = _full_in_runs(df, keys, periods, kinds)
    out = []
    for c in indicator_columns(periods):
        kind, _, p = c.partition("_")
        if kind == "obv":
            out.append(F.col(c))
        elif kind in kinds:
            need = needs(int(p))[kind]
            ok = F.col("rn") >= need if max_history is None or need <= max_history else F.lit(False)
            out.append(F.when(ok, F.col(c)).alias(c))
    return made.select(*[F.col("_rn").alias(c) if c == "rn" else F.col(c) for c in candle_rows.columns], *out)


def assemble(indicator_rows: DataFrame, periods=PERIODS) -> DataFrame:
    """The full feature-table row; `created_at` stays NULL unless the input sets it."""
    have = set(indicator_rows.columns)
    return indicator_rows.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in feature_schema(periods)])
