"""Streams in which every key has its own clock."""

import random
import time

import pytest
from pyspark.sql import functions as F, types as T

from test_streaming import MINUTE, TRADE, land, read_topic, run, trade
from tickloom.operators.candles import COLUMNS, candles
from tickloom.streaming import flows, perkey


def topic(spark, folder, schema=TRADE):
    return flows.topic(spark, schema, f"{folder}/in", max_files=1)


def batch(spark, data):
    return {tuple(r) for r in candles(spark.createDataFrame([tuple(t.values()) for t in data], TRADE), 60).collect()}


def found(spark, folder, status):
    rows = read_topic(spark, f"{folder}/out", perkey.STATUS).filter(F.col("status") == status)
    return [tuple(r) for r in rows.select(*COLUMNS).collect()]


def test_two_clocks_a_day_apart(spark, folder):
    """B comes in a day behind A in every file; neither loses a trade."""
    draw = random.Random(4)
    day = 86_400_000
    data = []
    for i in range(240):
        data.append(trade(day + i * 9_000 + draw.randrange(30_000), draw.randrange(1, 90) / 1.0, 2 * i, "A"))
        price = None if i % 11 == 0 else draw.randrange(1, 90) / 1.0
        data.append(trade(i * 9_000 + draw.randrange(30_000), price, 2 * i + 1, "B"))
    for n in range(6):
        land(f"{folder}/in", n, data[n * 80:(n + 1) * 80])
    made = perkey.pair_candle_stream(topic(spark, folder), 60, delay_ms=2 * MINUTE)
    run(flows.to_topic(made, f"{folder}/state", f"{folder}/out"))
    newest = {p: max(t["timestamp_ms"] for t in data if t["product_id"] == p) for p in "AB"}
    want = {c for c in batch(spark, data) if c[7] <= newest[c[0]] - 2 * MINUTE}
    got = found(spark, folder, "closed")
    assert len(got) == len(set(got)) and set(got) == want
    assert not found(spark, folder, "late")


def test_late_trades_leave_as_late_candles(spark, folder):
    land(f"{folder}/in", 1, [trade(0, 10.0, 1), trade(1_000, 12.0, 2), trade(10 * MINUTE, 20.0, 3)])
    land(f"{folder}/in", 2, [trade(2_000, 99.0, 4), trade(3_000, 1.0, 5), trade(9 * MINUTE, 7.0, 6)])
    land(f"{folder}/in", 3, [trade(20 * MINUTE, 40.0, 7)])
    made = perkey.pair_candle_stream(topic(spark, folder), 60, delay_ms=2 * MINUTE)
    run(flows.to_topic(made, f"{folder}/state", f"{folder}/out"))
    assert sorted((c[6], c[1], c[2], c[3], c[4], c[5]) for c in found(spark, folder, "closed")) == [
        (0, 10.0, 12.0, 10.0, 12.0, 2.0), (9 * MINUTE, 7.0, 7.0, 7.0, 7.0, 1.0), (10 * MINUTE, 20.0, 20.0, 20.0, 20.0, 1.0)]
    assert [c[1:6] for c in found(spark, folder, "late")] == [(99.0, 99.0, 1.0, 1.0, 2.0)]


def test_updates_show_open_windows(spark, folder):
    land(f"{folder}/in", 1, [trade(0, 10.0, 1)])
    land(f"{folder}/in", 2, [trade(1_000, 30.0, 2), trade(61_000, 5.0, 3)])
    made = perkey.pair_candle_stream(topic(spark, folder), 60, delay_ms=MINUTE, updates=True)
    run(flows.to_topic(made, f"{folder}/state", f"{folder}/out"))
    assert sorted((c[6], c[2], c[4]) for c in found(spark, folder, "open")) == [
        (0, 10.0, 10.0), (0, 30.0, 30.0), (MINUTE, 5.0, 5.0)]


@pytest.mark.parametrize("seed", range(3))
def test_partial_candles_merge_in_any_order(seed):
    draw = random.Random(seed)
    trades = [(i, draw.choice([None, float(draw.randrange(9))]), draw.choice([None, 1.0, 2.0])) for i in range(12)]
    parts = [(i if p is not None else None, p, p, p, i if p is not None else None, p, q) for i, p, q in trades]
    draw.shuffle(parts)
    while len(parts) > 1:
        a, b = parts.pop(draw.randrange(len(parts))), parts.pop(draw.randrange(len(parts)))
        parts.append(perkey.merge(a, b))
    prices = [(i, p) for i, p, _ in trades if p is not None]
    volume = [q for _, _, q in trades if q is not None]
    assert parts[0] == (prices[0][0], prices[0][1], max(p for _, p in prices), min(p for _, p in prices),
                        prices[-1][0], prices[-1][1], sum(volume))


def wait(query, done, seconds=60):
    end = time.time() + seconds
    while not done() and time.time() < end:
        if query.exception():
            raise query.exception()
        time.sleep(0.3)
    query.stop()


def test_an_idle_pair_closes_its_windows(spark, folder):
    land(f"{folder}/in", 1, [trade(0, 10.0, 1), trade(61_000, 20.0, 2)])
    made = perkey.pair_candle_stream(topic(spark, folder), 60, delay_ms=60 * MINUTE, idle_ms=500)
    query = flows.to_topic(made, f"{folder}/state", f"{folder}/out").start()
    schema = "key string, value string"
    wait(query, lambda: __import__("os").path.isdir(f"{folder}/out") and spark.read.schema(schema).json(f"{folder}/out").count() >= 2)
    assert sorted(c[6] for c in found(spark, folder, "closed")) == [0, MINUTE]


def test_silence_by_the_feeds_clock(spark, folder):
    """B falls silent and comes back: one alarm for each silence; A never is silent."""
    land(f"{folder}/in", 1, [trade(i * MINUTE, 1.0, i, "A") for i in range(10)] + [trade(MINUTE, 1.0, 50, "B")])
    land(f"{folder}/in", 2, [trade(i * MINUTE, 1.0, i, "A") for i in range(10, 13)])
    land(f"{folder}/in", 3, [trade(13 * MINUTE, 1.0, 60, "A"), trade(13 * MINUTE, 1.0, 61, "B")])
    land(f"{folder}/in", 4, [trade(i * MINUTE, 1.0, i + 50, "A") for i in range(14, 30)])
    made = perkey.silence_alarms(topic(spark, folder), 300, clock="event", delay="1 minute")
    run(flows.to_topic(made, f"{folder}/state", f"{folder}/out", key="product_id"))
    got = sorted(tuple(r) for r in read_topic(spark, f"{folder}/out", perkey.ALARM).collect())
    assert got == [("B", MINUTE, 6 * MINUTE), ("B", 13 * MINUTE, 18 * MINUTE)]


def test_silence_by_the_wall_clock(spark, folder):
    land(f"{folder}/in", 1, [trade(MINUTE, 1.0, 1, "B")])
    query = flows.to_topic(perkey.silence_alarms(topic(spark, folder), 1), f"{folder}/state", f"{folder}/out",
                           key="product_id").start()
    schema = "key string, value string"
    wait(query, lambda: __import__("os").path.isdir(f"{folder}/out") and spark.read.schema(schema).json(f"{folder}/out").count() > 0)
    rows = read_topic(spark, f"{folder}/out", perkey.ALARM).collect()
    assert [(r.product_id, r.last_ms) for r in rows] == [("B", MINUTE)]


def test_life_time_counts_from_arrival(spark, folder):
    """Repeats within ten minutes of arrival go; the same key later passes, whatever its event
    time. Row 4 is the first after the life time, and the micro-batch after it cleans at its end."""
    schema = T.StructType([*TRADE.fields, T.StructField("came", T.LongType())])
    arrivals = [(1, 1000), (2, 1005), (3, 1009), (4, 1011), (5, 1012), (6, 1030), (8, 1032)]
    for seq, minute in arrivals:
        other = {**trade(minute * MINUTE, 1.0, 100 + seq, "other"), "came": minute * MINUTE}
        land(f"{folder}/in", seq, [{**trade(MINUTE, 1.0, seq), "came": minute * MINUTE}, other])
    land(f"{folder}/in", 7, [{**trade(MINUTE, 1.0, 7, None), "came": 1031 * MINUTE}] * 2)
    rows = topic(spark, folder, schema).withColumn("came", F.timestamp_millis("came"))
    seen = perkey.dedup_by_arrival(rows, "trades", 600, arrived="came").drop("came")
    query = run(flows.to_topic(seen, f"{folder}/state", f"{folder}/out", key="product_id"))
    got = read_topic(spark, f"{folder}/out", TRADE).filter("product_id is null or product_id <> 'other'").collect()
    assert sorted(r.seq for r in got) == [1, 6, 7, 7]
    assert perkey.held_keys(query)[0] == 2


def test_predictions_without_a_candle(spark, folder):
    schema = "pair string, window_start_ms long, {} double"
    hour = 3_600_000
    spark.createDataFrame([("A", 0, 10.0), ("A", hour, 11.0), ("A", 26 * hour, 5.0), ("Z", 900 * hour, 1.0)],
                          schema.format("prediction")).write.parquet(f"{folder}/predictions")
    spark.createDataFrame([("A", 2 * hour, 14.0), ("Z", 900 * hour, 1.0)], schema.format("close")).write.parquet(f"{folder}/candles")

    def streams():
        return (spark.readStream.schema(schema.format("prediction")).parquet(f"{folder}/predictions"),
                spark.readStream.schema(schema.format("close")).parquet(f"{folder}/candles"))

    made = flows.prediction_alarm_stream(*streams(), 2 * hour, 3.0)
    kind = made.schema
    run(flows.to_topic(made, f"{folder}/state", f"{folder}/out"))
    got = sorted(tuple(r) for r in read_topic(spark, f"{folder}/out", kind).filter("pair = 'A'").collect())
    assert got == [("A", 0, 1, 4.0, 1, True), ("A", 24 * hour, 0, None, 1, False)]
    errors = flows.prediction_error_stream(*streams(), 2 * hour, unmatched=True)
    kind = errors.schema
    run(flows.to_topic(errors, f"{folder}/state2", f"{folder}/out2"))
    assert sorted((r.window_start_ms, r.actual) for r in read_topic(spark, f"{folder}/out2", kind).filter("pair = 'A'").collect()) == [
        (0, 14.0), (hour, None), (26 * hour, None)]
