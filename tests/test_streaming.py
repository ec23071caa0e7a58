import json
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from tickloom.operators.candles import COLUMNS, candles
from tickloom.operators.indicators import indicators
from tickloom.schemas import CANDLE, indicator_columns
from tickloom.sinks.tables import from_keyed_json, keyed_json
from tickloom.sources.tables import read_feature_table
from tickloom.streaming import flows
from tickloom.streaming.stateful import IndicatorProcessor, indicator_stream

TRADE = T.StructType([
    T.StructField("product_id", T.StringType()), T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()), T.StructField("timestamp_ms", T.LongType()),
    T.StructField("seq", T.LongType())])
MINUTE = 60_000


def land(folder, number, rows):
    """One file of keyed messages; files are read in the order of their modification."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{number:03d}.json"
    with open(path, "w") as out:
        for row in rows:
            out.write(json.dumps({"key": row.get("pair") or row.get("product_id"), "value": json.dumps(row)}) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def trade(ms, price, seq, product="A", quantity=1.0):
    return {"product_id": product, "price": price, "quantity": quantity, "timestamp_ms": ms, "seq": seq}


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_topic(spark, path, schema):
    return from_keyed_json(spark.read.schema("key string, value string").json(path), schema)


def test_late_trades(spark, folder):
    """A trade within the delay changes its candle; one behind the watermark is dropped."""
    land(f"{folder}/in", 1, [trade(0, 10.0, 1), trade(5 * MINUTE, 20.0, 2)])
    land(f"{folder}/in", 2, [trade(4 * MINUTE, 30.0, 3)])              # late, within two minutes
    land(f"{folder}/in", 3, [trade(20 * MINUTE, 40.0, 4)])
    land(f"{folder}/in", 4, [trade(30_000, 99.0, 5)])                  # far behind
    land(f"{folder}/in", 5, [trade(21 * MINUTE, 50.0, 6)])
    rows = flows.topic(spark, TRADE, f"{folder}/in", max_files=1)
    made = flows.candle_stream(flows.with_event_time(rows, delay="2 minutes"), 60)
    run(flows.to_feature_table(made, f"{folder}/table", f"{folder}/state", mode="update"))
    got = {r.window_start_ms // MINUTE: r.high for r in read_feature_table(spark, f"{folder}/table").collect()}
    assert got == {0: 10.0, 4: 30.0, 5: 20.0, 20: 40.0, 21: 50.0}


def test_append_emits_closed_candles_once(spark, folder):
    draw = random.Random(1)
    data = [trade(i * 7_000, draw.randint(1, 99) / 1.0, i, draw.choice("AB")) for i in range(300)]
    for i in range(5):
        land(f"{folder}/in", i, data[i * 60:(i + 1) * 60])
    rows = flows.topic(spark, TRADE, f"{folder}/in", max_files=2)
    made = flows.candle_stream(flows.with_event_time(rows, delay="1 minute"), 60)
    run(flows.to_topic(made, f"{folder}/state", f"{folder}/out"))
    got = {tuple(r) for r in read_topic(spark, f"{folder}/out", CANDLE).select(*COLUMNS).collect()}
    batch = candles(spark.createDataFrame([tuple(t.values()) for t in data], TRADE), 60)
    mark = max(t["timestamp_ms"] for t in data) - MINUTE
    assert got == {tuple(r) for r in batch.filter(F.col("window_end_ms") <= mark).collect()}


def test_dedup_with_time_to_live(spark, folder):
    none = {"product_id": None, "price": 1.0, "quantity": 1.0, "timestamp_ms": 0, "seq": 9}
    land(f"{folder}/in", 1, [trade(MINUTE, 1.0, 1), trade(MINUTE, 2.0, 2), none, none])
    land(f"{folder}/in", 2, [trade(MINUTE, 3.0, 3), trade(60 * MINUTE, 4.0, 4)])
    rows = flows.topic(spark, TRADE, f"{folder}/in", max_files=1)
    out = flows.dedup_counts(rows, "trades", "10 minutes").drop("event_time")
    query = run(flows.to_topic(out, f"{folder}/state", f"{folder}/out", key="product_id"))
    got = read_topic(spark, f"{folder}/out", TRADE).collect()
    assert sorted(r.seq for r in got if r.product_id) == [1, 4]
    assert sum(r.product_id is None for r in got) == 2
    seen = [p["observedMetrics"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(m["trades_in"]["rows"] for m in seen if "trades_in" in m) == 6


def bar(i, close, pair="A"):
    return {"pair": pair, "open": close, "high": close + 1, "low": close - 1, "close": close, "volume": 2.0,
            "window_start_ms": i * MINUTE, "window_end_ms": (i + 1) * MINUTE, "window_in_sec": 60}


def test_indicator_stream_equals_batch(spark, folder):
    """Candles in several files, with revisions of the last candle on the way."""
    draw = random.Random(3)
    final = {}
    number = 0
    for pair in "AB":
        for start in range(0, 60, 12):
            rows = []
            for i in range(start, start + 12):
                rows += [bar(i, draw.randint(10, 99) / 1.0, pair) for _ in range(draw.choice([1, 2]))]
                final[(pair, i)] = rows[-1]
            land(f"{folder}/in", number, rows)
            number += 1
    rows = flows.topic(spark, CANDLE, f"{folder}/in", max_files=1)
    run(flows.to_feature_table(indicator_stream(rows, (7, 14)), f"{folder}/table", f"{folder}/state"))
    got = {(r.pair, r.window_start_ms): r for r in read_feature_table(spark, f"{folder}/table").collect()}
    batch = indicators(spark.createDataFrame([tuple(b.values()) for b in final.values()], CANDLE), (7, 14)).collect()
    assert len(got) == len(batch) == 120
    for r in batch:
        for c in indicator_columns((7, 14)):
            other = got[(r.pair, r.window_start_ms)][c]
            assert (other is None) == (r[c] is None) and (other is None or other == pytest.approx(r[c], abs=1e-9)), c


def test_late_revision_goes_to_its_place(spark, folder):
    land(f"{folder}/in", 1, [bar(i, float(i)) for i in range(8)])
    land(f"{folder}/in", 2, [bar(3, 30.0)])
    land(f"{folder}/in", 3, [bar(8, 8.0)])
    rows = flows.topic(spark, CANDLE, f"{folder}/in", max_files=1)
    run(flows.to_feature_table(indicator_stream(rows, (7,)), f"{folder}/table", f"{folder}/state"))
    last = read_feature_table(spark, f"{folder}/table").orderBy(F.desc("window_start_ms")).first()
    assert last.sma_7 == pytest.approx((2 + 30 + 4 + 5 + 6 + 7 + 8) / 7)


def test_backfill_resumes_where_it_left_off(spark, folder):
    for i in range(4):
        land(f"{folder}/in", i, [trade(i * 10 + j, 1.0, i * 10 + j) for j in range(10)])
    args = (spark, TRADE, f"{folder}/in", f"{folder}/out", f"{folder}/state")
    first = flows.publish_backfill(*args)
    first.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in first.recentProgress) == 4
    land(f"{folder}/in", 9, [trade(90, 1.0, 90)])
    flows.publish_backfill(*args).awaitTermination()
    assert read_topic(spark, f"{folder}/out", TRADE).count() == 41
    flows.publish_all(read_topic(spark, f"{folder}/out", TRADE), f"{folder}/again")
    assert read_topic(spark, f"{folder}/again", TRADE).count() == 41


def test_prediction_error_stream(spark, folder):
    schema = T.StructType([T.StructField("pair", T.StringType()), T.StructField("window_start_ms", T.LongType()),
                           T.StructField("prediction", T.DoubleType())])
    land(f"{folder}/pred", 1, [{"pair": "A", "window_start_ms": i * MINUTE, "prediction": float(i)} for i in range(6)])
    land(f"{folder}/bars", 1, [bar(i, 10.0) for i in range(8)])
    joined = flows.prediction_error_stream(flows.topic(spark, schema, f"{folder}/pred"),
                                           flows.topic(spark, CANDLE, f"{folder}/bars"), 5 * MINUTE)
    run(flows.to_topic(joined, f"{folder}/state", f"{folder}/out"))
    out = read_topic(spark, f"{folder}/out", T.StructType([
        T.StructField("window_start_ms", T.LongType()), T.StructField("abs_error", T.DoubleType())])).collect()
    assert sorted((r.window_start_ms // MINUTE, r.abs_error) for r in out) == [(0, 10.0), (1, 9.0), (2, 8.0)]


def test_keyed_json_round_trip(spark):
    df = spark.createDataFrame([tuple(bar(1, 5.0).values())], CANDLE)
    message = keyed_json(df).first()
    assert message.key == "A" and json.loads(message.value)["close"] == 5.0
    assert from_keyed_json(keyed_json(df), CANDLE).collect() == df.collect()
    assert flows.not_empty(df.withColumn("x", F.lit(None)), "x").count() == 0


class Held:
    """A state variable in memory."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value or []

    put = update = lambda self, value: setattr(self, "value", value)


def sent(block, batches):
    """The last version of every window that a processor sends."""
    processor = IndicatorProcessor((7,), max_history=20, block=block)
    processor.candles, processor.numbers = Held(), Held()
    made = [rows for parts in batches for rows in processor.handleInputRows(("A",), iter(parts), None)]
    return pd.concat(made).drop_duplicates("window_start_ms", keep="last").sort_values(
        "window_start_ms").drop(columns="version").reset_index(drop=True)


def test_no_candle_is_lost_in_a_batch_of_many_blocks(folder):
    """Shuffled rows in blocks far smaller than the batch give what one large block gives."""
    draw = random.Random(8)
    bars = [bar(i, draw.randint(10, 99) / 1.0) for i in range(600)]
    batches = []
    for rows in (bars[:400], bars[395:]):
        draw.shuffle(rows)
        batches.append([pd.DataFrame(rows[i:i + 13]) for i in range(0, len(rows), 13)])
    got = sent(50, batches)
    assert len(got) == 600
    pd.testing.assert_frame_equal(got, sent(100_000, batches))
