import json

import pytest
from pyspark.sql import functions as F

from tickloom.functions.scalars import iso_to_ms, registered_name, seconds_to_cursor, whole_second
from tickloom.operators import selection as S
from tickloom.sinks import tables as K
from tickloom.sources import decode, tables as T, versions as V

PAGE = "product_id string, request_no long, body string"


def page(trades, last="1704067200123456789", error=(), key="XXBTZEUR"):
    return json.dumps({"error": list(error), "result": {key: trades, "last": last}})


def test_decode_pages(spark):
    good = ["42000.5", "0.25", 1704067200.1239, "b", "l", ""]
    whole = ["1", "2", 1704067201, "s", "m", ""]
    pages = spark.createDataFrame([
        ("BTC/EUR", 1, page([good, ["x", "1", 1.0, "b", "l", ""], ["1"], whole])),
        ("BTC/EUR", 2, page([good], error=["EGeneral:Too many requests"])),
        ("BTC/EUR", 3, page([])),
        ("BTC/EUR", 4, '{"error":[],"result":{"last":"5"}}'),
        ("BTC/EUR", 5, "not json")], PAGE)
    rows = decode.decode_pages(pages).orderBy("seq").collect()
    assert [tuple(r) for r in rows] == [
        ("BTC/EUR", 42000.5, 0.25, "2024-01-01T00:00:00.123900", 1704067200123, 1_000_000),
        ("BTC/EUR", 1.0, 2.0, "2024-01-01T00:00:01", 1704067201000, 1_000_003)]
    assert [r.position for r in decode.rejected_trades(pages).orderBy("position").collect()] == [1, 2]
    summary = {r.request_no: (r.trades, r.cursor) for r in decode.page_summary(pages).collect()}
    assert summary[1] == (4, "1704067200123456789") and summary[2][0] == 0 and summary[3][0] == 0
    assert summary[5] == (None, None)
    assert {(r.request_no, r.reason) for r in decode.rejected_pages(pages).collect()} == {(2, "error"), (5, "not a page")}


def test_page_audit(spark):
    rows = [("A", 1, 5, "10"), ("A", 2, 5, "20"), ("A", 3, 0, None), ("A", 4, 5, "20"),
            ("A", 5, 0, None), ("A", 6, 0, None), ("A", 7, 0, None), ("A", 8, 0, None), ("A", 9, 3, "30"),
            ("B", 1, 0, None), ("B", 2, 0, None)]
    df = spark.createDataFrame(rows, "product_id string, request_no long, trades int, cursor string")
    found = {(r.product_id, r.request_no, r.problem) for r in decode.page_audit(df).collect()}
    assert found == {("A", 4, "cursor_not_moving"), ("A", 7, "three_empty_pages"), ("A", 8, "three_empty_pages")}


def test_decode_messages(spark):
    data = {"channel": "trade", "data": [
        {"symbol": "BTC/EUR", "price": 1.5, "qty": 2.0, "timestamp": "2024-01-01T00:00:00.123456Z"},
        {"symbol": "ETH/EUR", "price": 3.5, "qty": 1.0, "timestamp": "2024-01-01T01:00:00+01:00"}]}
    df = spark.createDataFrame([(json.dumps(data),), ('{"channel":"heartbeat"}',), ('{"channel":"status"}',),
                                ("garbage",)], "value string")
    rows = decode.decode_messages(df).orderBy("product_id").collect()
    assert [(r.product_id, r.price, r.timestamp_ms) for r in rows] == [
        ("BTC/EUR", 1.5, 1704067200123), ("ETH/EUR", 3.5, 1704067200000)]
    bad = {"channel": "trade", "data": [{"symbol": "X", "price": 1.0, "qty": 1.0, "timestamp": "noon"}, {"price": 1.0}]}
    numbered = df.unionByName(spark.createDataFrame([(json.dumps(bad),)], "value string")).withColumn("offset", F.lit(7))
    assert sorted(r.seq for r in decode.decode_messages(numbered, arrival="offset").collect()) == [7_000_000, 7_000_001]
    assert sorted(r.reason for r in decode.rejected_messages(numbered).collect()) == ["no product", "no time", "not a message"]


def test_every_message_gives_a_trade_or_a_reason(spark):
    trade = {"symbol": "BTC/EUR", "price": 1.5, "qty": 2.0, "timestamp": "2024-01-01T00:00:00Z"}
    rows = [json.dumps({"channel": "trade", "data": {"symbol": "A"}}), json.dumps({"channel": "trade"}), None,
            json.dumps({"channel": "trade", "data": [trade], "note": "after a heartbeat"}),
            json.dumps({"channel": "heartbeat"}), json.dumps({"channel": "status", "data": [{"system": "online"}]})]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    assert [r.product_id for r in decode.decode_messages(df).collect()] == ["BTC/EUR"]
    assert sorted(r.reason for r in decode.rejected_messages(df).collect()) == ["no array of data", "no array of data", "no text"]


def test_scalars(spark):
    row = spark.range(1).select(
        whole_second(F.lit(1999).cast("bigint")).cast("string").alias("s"),
        seconds_to_cursor(F.lit(1.5)).alias("c"), iso_to_ms(F.lit("nonsense")).alias("bad"),
        registered_name(F.lit("BTC/EUR"), F.lit("Ridge"), F.lit(5)).alias("n")).first()
    assert tuple(row) == ("1970-01-01 00:00:01", "1500000000", None, "BTC_EUR_Ridge_5")


def test_backfill_progress(spark):
    day = T.DAY_MS
    df = spark.createDataFrame([("A", 0), ("A", 3 * day), ("B", 0), ("B", 90 * day)],
                               "product_id string, timestamp_ms long")
    rows = {r.product_id: (r.days_covered, r.percent) for r in T.backfill_progress(df, 30).collect()}
    assert rows == {"A": (3.0, 10.0), "B": (90.0, 100.0)}


def feature_rows(spark, value, n=3, pair="BTC/EUR"):
    return spark.range(n).selectExpr(f"'{pair}' AS pair", f"{value}D AS close", "id * 60000 AS window_start_ms",
                                     "id * 60000 + 60000 AS window_end_ms")


def test_upsert_keeps_the_last_version_and_prunes(spark, folder):
    K.upsert(feature_rows(spark, 1, 5), 1, folder)
    K.upsert(feature_rows(spark, 2), 2, folder)
    K.upsert(feature_rows(spark, 2), 2, folder)
    K.upsert(feature_rows(spark, 3, 1, "ETH/EUR"), 3, folder)
    rows = T.read_feature_table(spark, folder).orderBy("pair", "window_start_ms").collect()
    assert [r.close for r in rows] == [2, 2, 2, 1, 1, 3]
    K.upsert(feature_rows(spark, 7, 2), 0, folder, run=1)
    rows = T.read_feature_table(spark, folder).orderBy("pair", "window_start_ms").collect()
    assert [r.close for r in rows] == [7, 7, 2, 1, 1, 3]
    K.compact(spark, folder, f"{folder}-compact")
    assert T.read_feature_table(spark, f"{folder}-compact").orderBy("pair", "window_start_ms").collect() == rows
    one = T.read_feature_table(spark, folder, "ETH/EUR", 0)
    assert [r.close for r in one.collect()] == [3]
    assert len(one.inputFiles()) == 1 and "ETH" in one.inputFiles()[0]


def test_many_batches_stay_readable(spark, folder):
    """Folders of a partition are merged; a merged table is read without a shuffle."""
    for batch in range(24):
        K.upsert(feature_rows(spark, batch, 3 + batch % 2), batch, folder, merge_after=8)
        folders = V.read(spark, folder)["partitions"][0][2]
        assert len(folders) <= 7
    rows = [r.close for r in T.read_feature_table(spark, folder).orderBy("window_start_ms").collect()]
    assert rows == [23, 23, 23, 23]
    gone = V.vacuum(spark, folder)
    assert gone and [r.close for r in T.read_feature_table(spark, folder).orderBy("window_start_ms").collect()] == rows
    K.compact(spark, folder, f"{folder}-one")
    plan = T.read_feature_table(spark, f"{folder}-one")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_swap(spark, folder):
    for name in ("old", "new"):
        feature_rows(spark, 1.0 if name == "old" else 2.0).write.parquet(f"{folder}/{name}")
    K.swap(spark, f"{folder}/new", f"{folder}/old", f"{folder}/before")
    assert {r.close for r in spark.read.parquet(f"{folder}/old").collect()} == {2.0}
    assert {r.close for r in spark.read.parquet(f"{folder}/before").collect()} == {1.0}
    with pytest.raises(ValueError):
        K.swap(spark, f"{folder}/absent", f"{folder}/old", f"{folder}/x")


def test_pairs_that_look_like_numbers_stay_text(spark, folder):
    K.upsert(feature_rows(spark, 1, 2, "007"), 0, folder)
    table = T.read_feature_table(spark, folder)
    assert dict(table.dtypes)["pair"] == "string" and {r.pair for r in table.collect()} == {"007"}


def test_clean_copy_and_exports(spark, folder):
    df = feature_rows(spark, 1).withColumn("created_at", F.lit(None).cast("timestamp"))
    twice = df.withColumn("seq", F.lit(1)).unionByName(df.withColumn("seq", F.lit(2)).withColumn("close", F.lit(9.0)))
    K.replace_with_clean_copy(twice, f"{folder}/clean")
    assert {r.close for r in spark.read.parquet(f"{folder}/clean").collect()} == {9.0}
    K.export_sample(df.drop("created_at"), f"{folder}/sample", 2)
    assert spark.read.option("header", True).csv(f"{folder}/sample").count() == 2
    board = spark.createDataFrame([("A", "x", 1.0), ("A", "y", 2.0)], "pair string, model string, mae double")
    K.export_comparison(board, board.filter("mae < 2"), f"{folder}/cmp")
    assert spark.read.option("header", True).csv(f"{folder}/cmp/top_models_csv").count() == 1
    assert spark.read.json(f"{folder}/cmp/models_comparison_json").count() == 2


def test_selection(spark):
    df = feature_rows(spark, 1, 30).unionByName(feature_rows(spark, 2, 30, "ETH/EUR"))
    assert [r.window_start_ms for r in S.latest_rows(df, "BTC/EUR", 2).collect()] == [29 * 60000, 28 * 60000]
    assert S.newest_per_pair(df, 4).count() == 8
    cut = S.DAY_MS + 10 * 60000
    assert S.pair_last_days(df, "BTC/EUR", 1, cut).first().window_start_ms == 11 * 60000
    assert S.training_horizon(df, 1, cut).filter("pair = 'BTC/EUR'").count() == 20
    assert S.training_horizon(df, 0, cut).count() == S.training_horizon(df, None, cut).count() == 60
