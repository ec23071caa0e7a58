"""Indicators on a stream of candles, with the recent candles of each pair as state."""

from __future__ import annotations

import heapq
import tempfile
from bisect import insort
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions.scalars import present
from tickloom.operators.indicators import needs, tail_arrays
from tickloom.schemas import CANDLE, PERIODS, indicator_columns

NAMES = CANDLE.names
START = NAMES.index("window_start_ms")
RUN_ROWS = 4096     # rows of a sorted run that are read at a time
STORED = T.StructType([*CANDLE.fields, T.StructField("arrival", T.LongType())])
NUMBERS = T.StructType([T.StructField("dropped", T.LongType()), T.StructField("sent", T.LongType())])


def longest_need(periods, max_history: int) -> int:
    """Candles that the longest indicator needs that `max_history` can hold at all."""
    return max([1] + [n for p in periods for n in needs(p).values() if n <= max_history])


class Series:
    """The retained candles of a pair, and what has to leave again after a change.

    The newest `max_history` candles can be revised. Those and the `need - 1` before them are
    kept, so that a revised candle always has its whole history; a revision of an older one
    is ignored. A change touches `need` windows: its own and the ones that look back at it.
    """

    def __init__(self, stored: list[tuple], dropped: int, max_history: int, need: int):
        self.candles = {c[START]: tuple(c) for c in stored}
        self.starts = sorted(self.candles)
        self.dropped, self.max_history, self.need = dropped, max_history, need
        self.touched: set[int] = set()

    def put(self, candle: tuple) -> None:
        """Take a version of a candle; of two versions the one that arrived later stays."""
        start = candle[START]
        have = self.candles.get(start)
        if have is not None and have[-1] > candle[-1]:
            return
        gone = self.dropped > 0 or len(self.starts) >= self.max_history + self.need - 1
        if gone and start < self.starts[-min(self.max_history, len(self.starts))]:
            return
        if have is None:
            insort(self.starts, start)
        self.candles[start] = candle
        self.touched.add(start)

    def changed(self) -> list[int]:
        """Positions whose indicators may differ now."""
        out, left = [], 0
        for i, start in enumerate(self.starts):
            left = self.need if start in self.touched else left - 1
            if left > 0:
                out.append(i)
        return out

    def cut(self) -> None:
        """Forget what neither a revision nor a look back can reach."""
        over = max(0, len(self.starts) - (self.max_history + self.need - 1))
        for start in self.starts[:over]:
            del self.candles[start]
        self.starts, self.dropped = self.starts[over:], self.dropped + over
        self.touched.clear()


def in_order(parts: list[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(parts).sort_values(["window_start_ms", "arrival"], kind="stable")


def spilled(run: pd.DataFrame):
    """A temporary file with the rows of a run; it goes when it is closed."""
    file = tempfile.TemporaryFile()
    table = pa.Table.from_pandas(run, preserve_index=False)
    with pa.ipc.new_stream(file, table.schema) as out:
        out.write_table(table, max_chunksize=RUN_ROWS)
    file.seek(0)
    return file


def read(file) -> Iterator[tuple]:
    with file, pa.ipc.open_stream(file) as batches:
        for batch in batches:
            yield from batch.to_pandas().itertuples(index=False, name=None)


class IndicatorProcessor(StatefulProcessor):
    """Indicators of every window that a micro-batch adds or changes.

    The candles of a pair are put in order of time over the whole micro-batch: sorted runs of
    `block` rows go to temporary files of the worker and are merged, so no candle is taken for
    a late one because of its place in the batch. After each block of the merged rows those of
    changed windows leave with a running `version`, and the series is cut, so memory holds a
    block, a few rows of every run and the retained candles of one pair. With `arrival`, a number that grows with time, the later version of
    a candle wins whatever the order in which versions come in.
    """

    def __init__(self, periods=PERIODS, max_history: int | None = None, arrival: str | None = None,
                 block: int = 100_000):
        self.periods = tuple(periods)
        self.max_history = max_history or 3 * max(self.periods) - 1
        self.arrival, self.block = arrival, block

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.candles = handle.getListState("candles", STORED)
        self.numbers = handle.getValueState("numbers", NUMBERS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        dropped, sent = self.numbers.get() if self.numbers.exists() else (0, 0)
        series = Series(list(self.candles.get()), dropped, self.max_history, longest_need(self.periods, self.max_history))
        for block in self.blocks(rows):
            for candle in block:
                series.put(candle)
            sent += 1
            yield self.rows(series, sent)
            series.cut()
        self.candles.put([series.candles[s] for s in series.starts])
        self.numbers.update((series.dropped, sent))

    def blocks(self, rows: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
        runs, held, n = [], [], 0
        for part in rows:
            held.append(part.assign(arrival=part[self.arrival] if self.arrival else 0)[[*NAMES, "arrival"]])
            n += len(part)
            if n >= self.block:
                runs.append(read(spilled(in_order(held))))
                held, n = [], 0
        if held:
            runs.append(in_order(held).itertuples(index=False, name=None))
        merged = heapq.merge(*runs, key=lambda c: (c[START], pd.isna(c[-1]), 0 if pd.isna(c[-1]) else c[-1]))
        while block := list(islice(merged, self.block)):
            yield block

    def rows(self, series: Series, version: int) -> pd.DataFrame:
        kept = [series.candles[s] for s in series.starts]
        high, low, close, volume = (np.array([c[i] for c in kept], dtype=float) for i in (2, 3, 4, 5))
        arrays = tail_arrays(high, low, close, volume, self.periods)
        at = series.changed()
        made = pd.DataFrame([kept[i][:len(NAMES)] for i in at], columns=NAMES)
        for c in indicator_columns(self.periods):
            made[c] = arrays[c][at]
        made["version"] = version
        return made

    def close(self) -> None:
        pass


def indicator_schema(periods=PERIODS) -> T.StructType:
    return T.StructType([*CANDLE.fields, *[T.StructField(c, T.DoubleType()) for c in indicator_columns(periods)],
                         T.StructField("version", T.LongType())])


def indicator_stream(candle_rows: DataFrame, periods=PERIODS, max_history: int | None = None,
                     mode: str = "Append", arrival: str | None = None) -> DataFrame:
    """Indicators for every candle that arrives or changes. Needs the RocksDB state store provider.

    `max_history` is the number of newest candles that can be revised; indicators that need
    more stay NULL. `version` grows with every change of a pair: the last version of a window
    is the valid one, and `to_feature_table` keeps that. `arrival` names a column that orders
    the versions of a candle. Limit the files or offsets per trigger of the source, so that a
    backfill comes in several micro-batches.
    """
    made = candle_rows.groupBy("pair").transformWithStateInPandas(
        statefulProcessor=IndicatorProcessor(periods, max_history, arrival),
        outputStructType=indicator_schema(periods), outputMode=mode, timeMode="None")
    cap = max_history or 3 * max(periods) - 1
    blank = [f"{kind}_{p}" for p in periods for kind, need in needs(p).items() if need > cap]
    return made.withColumns({c: F.lit(None).cast("double") if c in blank else present(c)
                             for c in indicator_columns(periods)})
