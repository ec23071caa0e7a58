"""From trades to the feature table, in one batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.operators.candles import candles
from tickloom.operators.dedup import dedup
from tickloom.operators.indicators import assemble, indicators
from tickloom.schemas import PERIODS
from tickloom.session import materialize


def feature_table(trades: DataFrame, window_in_sec: int = 60, periods=PERIODS, seed: str = "tail",
                  max_history: int | None = None, arrival: str = "seq",
                  extra_key: tuple[str, ...] = ()) -> DataFrame:
    """De-duplicated trades, candles, indicators, and the full feature row.

    Candles are far fewer than trades and are read twice (numbering, indicators), so they
    are kept once.
    """
    unique = dedup(trades, "trades", arrival=arrival, extra_key=extra_key)
    bars = materialize(candles(unique, window_in_sec, arrival))
    return assemble(indicators(bars, periods, seed, max_history, step_ms=window_in_sec * 1000), periods)
