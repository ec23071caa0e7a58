"""Streams in which every key keeps a clock of its own: candles that close per pair, alarms of
silent feeds, and repeats told apart by their time of arrival.

Candles and alarms need the RocksDB state store provider. Before the rows of a key meet in one
task, every task reduces its own (partial candles, newest trade), so a key that holds a third
of all trades brings a few rows per task and window only.

By processing time (`idle_ms`, the "processing" clock) Spark always runs a next
batch, since a timer may be due; such a query runs until it is stopped, or one batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators.dedup import KEYS, _complete
from tickloom.schemas import CANDLE

PARTIAL = ("pair string, window_start_ms long, open_at long, open double, high double, low double, "
           "close_at long, close double, volume double, newest_ms long")
KEPT = T.StructType([T.StructField(c, T.LongType() if c.endswith("_at") else T.DoubleType()) for c in
                     ("open_at", "open", "high", "low", "close_at", "close", "volume")])
CLOCK = T.StructType([T.StructField("newest_ms", T.LongType()), T.StructField("closed_ms", T.LongType())])
STATUS = T.StructType([*CANDLE.fields, T.StructField("status", T.StringType())])


# --- candles that close per pair ------------------------------------------------------

def _known(value):
    """NULL for what pandas marks as missing."""
    return None if value is None or value != value else value


def _pick(a, b, use):
    return b if a is None else a if b is None else use(a, b)


def merge(a: tuple, b: tuple) -> tuple:
    """Two partial candles of one window as one: the earlier open, the later close."""
    first = b if a[0] is None or (b[0] is not None and b[0] < a[0]) else a
    last = b if a[4] is None or (b[4] is not None and b[4] >= a[4]) else a
    return (first[0], first[1], _pick(a[2], b[2], max), _pick(a[3], b[3], min), last[4], last[5],
            _pick(a[6], b[6], lambda x, y: x + y))


def partial_candles(trades: DataFrame, window_in_sec: int, arrival: str = "seq") -> DataFrame:
    """The trades of each task as partial candles; trades without a price open and close none."""
    width = window_in_sec * 1000

    def reduce(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part = part.assign(window_start_ms=part["ms"] // width * width).sort_values("at", kind="stable")
            key = ["pair", "window_start_ms"]
            priced = part[part["price"].notna()].groupby(key, dropna=False)
            whole = part.groupby(key, dropna=False)
            made = whole.agg(newest_ms=("ms", "max")).join(whole["quantity"].sum(min_count=1).rename("volume")).join(
                priced.agg(open_at=("at", "first"), open=("price", "first"), high=("price", "max"),
                           low=("price", "min"), close_at=("at", "last"), close=("price", "last")))
            made = made.reset_index().astype({"open_at": "Int64", "close_at": "Int64"})
            yield made[["pair", "window_start_ms", "open_at", "open", "high", "low", "close_at", "close", "volume", "newest_ms"]]

    rows = trades.select(F.col("product_id").alias("pair"), F.col("timestamp_ms").alias("ms"), F.col(arrival).alias("at"),
                         F.col("price").cast("double").alias("price"), F.col("quantity").cast("double").alias("quantity"))
    return rows.filter(F.col("ms").isNotNull()).mapInPandas(reduce, PARTIAL)


class PairCandles(StatefulProcessor):
    """Candles of a pair by the pair's own clock: its newest trade so far, less the delay."""

    def __init__(self, width: int, delay_ms: int, idle_ms: int | None, updates: bool):
        self.width, self.delay_ms, self.idle_ms, self.updates = width, delay_ms, idle_ms, updates

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", T.StructType([T.StructField("start", T.LongType())]), KEPT)
        self.clock = handle.getValueState("clock", CLOCK)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest, closed = self.clock.get() if self.clock.exists() else (None, None)
        changed, late = {}, {}
        for part in rows:
            for row in part.itertuples(index=False):
                start, kept = int(row[1]), tuple(_known(v) for v in row[2:9])
                into = late if closed is not None and start + self.width <= closed else changed
                into[start] = merge(into[start], kept) if start in into else kept
                newest = max(newest, int(row[9])) if newest is not None else int(row[9])
        known = {int(k[0]): tuple(_known(x) for x in v) for k, v in self.windows.iterator()}
        for start, kept in changed.items():
            known[start] = merge(known[start], kept) if start in known else kept
        mark = newest - self.delay_ms
        closed = mark if closed is None else max(closed, mark)
        done = {s: c for s, c in known.items() if s + self.width <= closed}
        for start in done:
            if self.windows.containsKey((start,)):
                self.windows.removeKey((start,))
        for start in changed:
            if start not in done:
                self.windows.updateValue((start,), known[start])
        self.clock.update((newest, closed))
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if len(known) > len(done):
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        open_ = {s: known[s] for s in changed if s not in done} if self.updates else {}
        yield self.rows(key[0], [(late, "late"), (done, "closed"), (open_, "open")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The pair has been silent for long: its open windows close."""
        known = {int(k[0]): tuple(_known(x) for x in v) for k, v in self.windows.iterator()}
        newest, closed = self.clock.get()
        self.windows.clear()
        self.clock.update((newest, max([closed, *(s + self.width for s in known)])))
        yield self.rows(key[0], [(known, "closed")])

    def rows(self, pair, groups) -> pd.DataFrame:
        made = [(pair, c[1], c[2], c[3], c[5], c[6], s, s + self.width, self.width // 1000, status)
                for found, status in groups for s, c in sorted(found.items())]
        return pd.DataFrame(made, columns=STATUS.names)

    def close(self) -> None:
        pass


def pair_candle_stream(trades: DataFrame, window_in_sec: int, delay_ms: int = 600_000, idle_ms: int | None = None,
                       updates: bool = False, arrival: str = "seq") -> DataFrame:
    """Candles with a `status`, closed by the clock of their own pair.

    A window leaves as `closed` when its pair has a trade `delay_ms` or more after its end, or
    when the pair has been silent for `idle_ms` of processing time (None: never). So a pair
    whose feed lags behind the others loses nothing. Trades of a window that has left already
    leave as a candle of their own with status `late`, which can be merged into the first one.
    With `updates` open windows leave as `open` whenever they change. No watermark is needed,
    and none must be set: it would drop the rows of slow pairs. Trades without a time are left
    out. A task holds the windows that a micro-batch touches of one pair, so limit the files or
    offsets per trigger of the source for a backfill.
    """
    return partial_candles(trades, window_in_sec, arrival).groupBy("pair").transformWithStateInPandas(
        statefulProcessor=PairCandles(window_in_sec * 1000, delay_ms, idle_ms, updates),
        outputStructType=STATUS, outputMode="Append", timeMode="None" if idle_ms is None else "ProcessingTime")


# --- silent feeds ---------------------------------------------------------------------

ALARM = T.StructType([T.StructField("product_id", T.StringType()), T.StructField("last_ms", T.LongType()),
                      T.StructField("due_ms", T.LongType())])


class SilenceAlarm(StatefulProcessor):
    """One timer per product, set anew by every newer trade; when it fires, an alarm leaves."""

    def __init__(self, limit_ms: int, by_event_time: bool):
        self.limit_ms, self.by_event_time = limit_ms, by_event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType([T.StructField("last_ms", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = max(int(part["last_ms"].max()) for part in rows)
        have = int(self.last.get()[0]) if self.last.exists() else None
        if have is None or newest > have or not self.by_event_time:
            newest = newest if have is None else max(have, newest)
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            now = newest if self.by_event_time else timerValues.getCurrentProcessingTimeInMs()
            self.handle.registerTimer(now + self.limit_ms)
            self.last.update((newest,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = int(expiredTimerInfo.getExpiryTimeInMs())
        yield pd.DataFrame([(key[0], int(self.last.get()[0]), due)], columns=ALARM.names)

    def close(self) -> None:
        pass


def silence_alarms(trades: DataFrame, limit_sec: int = 300, clock: str = "processing", delay: str = "1 minute") -> DataFrame:
    """One row (product_id, last_ms, due_ms) for every silence, without a further trade of that product.

    By the "processing" clock a product is silent `limit_sec` after its last rows arrived; by
    the "event" clock when the other products' trades, less the delay, are that far ahead of
    its newest one. The next trade of the product arms the alarm again.
    """
    if clock not in ("processing", "event"):
        raise ValueError(f"unknown clock: {clock}")

    def newest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.groupby("product_id", dropna=False)["last_ms"].max().reset_index()

    rows = trades.select("product_id", F.col("timestamp_ms").alias("last_ms")).filter(F.col("last_ms").isNotNull())
    rows = rows.mapInPandas(newest, "product_id string, last_ms long")
    by_event_time = clock == "event"
    if by_event_time:
        rows = rows.withColumn("event_time", F.timestamp_millis("last_ms")).withWatermark("event_time", delay)
    return rows.groupBy("product_id").transformWithStateInPandas(
        statefulProcessor=SilenceAlarm(limit_sec * 1000, by_event_time), outputStructType=ALARM,
        outputMode="Append", timeMode="EventTime" if by_event_time else "ProcessingTime")


# --- repeats by time of arrival -------------------------------------------------------

def dedup_by_arrival(df: DataFrame, kind: str, ttl_sec: float = 3600, arrived: str | None = None,
                     extra_key: tuple[str, ...] = ()) -> DataFrame:
    """First row per key; a key is forgotten `ttl_sec` after its first row came in, whatever the event times.

    A repeat does not start the time anew. The arrival is the start of the micro-batch, or the
    timestamp column `arrived`, such as the one a broker writes. The watermark runs on that
    time: a key is held until half the life time after its arrival, and the watermark stays
    the other half behind. Keys are forgotten at the end of micro-batches, as in a cache that
    is cleaned from time to time: a micro-batch cleans by the arrivals up to the one before it,
    so what comes in with the first rows after the life time still meets the key. Rows with a
    missing key part go round the state. `held_keys` tells how many keys are held.
    """
    if kind not in KEYS:
        return df
    key = KEYS[kind] + list(extra_key)
    came = F.col(arrived) if arrived else F.current_timestamp()
    seen = df.filter(_complete(key)).withColumn("_arrived", came).withWatermark(
        "_arrived", f"{max(1, round(ttl_sec * 500))} milliseconds")
    return seen.dropDuplicatesWithinWatermark(key).drop("_arrived").unionByName(df.filter(~_complete(key)))


def held_keys(query) -> list[int]:
    """Keys held in state after each micro-batch of a running or ended query."""
    return [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
