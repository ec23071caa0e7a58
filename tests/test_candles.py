import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import candles as C

TRADE = "product_id string, price double, quantity double, timestamp_ms long, seq long"


def test_window_edges_and_ties(spark):
    df = spark.createDataFrame([
        ("A", 10.0, 1.0, 60_000, 1), ("A", 12.0, 2.0, 119_999, 2),
        ("A", 7.0, 1.0, 120_000, 4), ("A", 9.0, 1.0, 120_000, 3)], TRADE)
    rows = {r.window_start_ms: r for r in C.candles(df, 60).collect()}
    assert set(rows) == {60_000, 120_000}
    assert tuple(rows[60_000])[1:6] == (10.0, 12.0, 10.0, 12.0, 3.0)
    assert (rows[120_000].open, rows[120_000].close) == (9.0, 7.0)
    assert rows[60_000].window_end_ms == 120_000 and rows[60_000].window_in_sec == 60


def test_arrival_and_event_time_order_differ_on_late_trades(spark):
    df = spark.createDataFrame([("A", 1.0, 1.0, 50, 1), ("A", 2.0, 1.0, 10, 2)], TRADE)
    by_arrival = C.candles(df, 60).first()
    by_time = C.candles(df, 60, open_close_by="event_time").first()
    assert (by_arrival.open, by_arrival.close) == (1.0, 2.0)
    assert (by_time.open, by_time.close) == (2.0, 1.0)
    with pytest.raises(ValueError):
        C.candles(df, 60, open_close_by="luck")


def random_trades(spark, n=4000, seed=3):
    draw = random.Random(seed)
    data = [("hot" if draw.random() < 0.7 else draw.choice("ABC"), draw.randint(1, 10_000) / 100,
             float(draw.randint(0, 9)), draw.randint(0, 20_000_000), i) for i in range(n)]
    return spark.createDataFrame(data, TRADE)


def as_set(df):
    return {tuple(r) for r in df.select(*C.COLUMNS).collect()}


def test_properties(spark):
    trades = random_trades(spark)
    bars = C.candles(trades, 60)
    assert bars.filter("low > open OR low > close OR high < open OR high < close").count() == 0
    assert bars.agg(F.sum("volume")).first()[0] == trades.agg(F.sum("quantity")).first()[0]
    assert as_set(bars) == as_set(C.candles(trades.repartition(13), 60))


def test_roll_up_equals_direct(spark):
    trades = random_trades(spark)
    small = C.candles(trades, 60, open_close_by="event_time")
    assert as_set(C.roll_up(small, 3600)) == as_set(C.candles(trades, 3600, open_close_by="event_time"))


def test_fill_gaps_across_blocks(spark, monkeypatch):
    from tickloom.functions import series

    monkeypatch.setattr(series, "BLOCK_ROWS", 4)
    monkeypatch.setattr(series, "CELL_ROWS", 3)
    bars = C.candles(random_trades(spark, 300), 60)
    rows = C.fill_gaps(bars, 60).orderBy("pair", "window_start_ms").collect()
    before = None
    for r in rows:
        if before is not None and before.pair == r.pair:
            assert r.window_start_ms == before.window_start_ms + 60_000
            if r.filled:
                assert (r.open, r.high, r.low, r.close, r.volume) == (before.close,) * 4 + (0.0,)
        else:
            assert not r.filled
        before = r
    assert sum(not r.filled for r in rows) == bars.count()


def test_own_aggregates(spark):
    df = random_trades(spark, 200)
    out = C.candles(df, 600, extra=[F.count(F.lit(1)).alias("trades")])
    assert out.columns == [*C.COLUMNS, "trades"]
    assert out.agg(F.sum("trades")).first()[0] == 200


def test_aggregation_is_hash_based_and_combines_early(spark):
    plan = C.candles(random_trades(spark, 10), 60)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "SortAggregate" not in plan
