"""Raw trade feeds to trades: pages of history and live messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.scalars import iso_to_ms, seconds_to_iso, seconds_to_ms
from tickloom.functions.series import drop_halo, number_rows, time_cell, with_halo
from tickloom.schemas import LIVE_MESSAGE, TRADE_PAGE

PAGE_CELL = 100_000
MAX_TRADES_PER_PAGE = 1_000_000
NO_TRADES = ("heartbeat", "status")     # channels without trades


def _opened(pages: DataFrame) -> DataFrame:
    """Pages with `_trades` (raw, as text), `_cursor` and `_reason`, the reason to reject the page."""
    page = pages.withColumn("_page", F.from_json("body", TRADE_PAGE))
    named = F.filter(F.map_entries("_page.result"), lambda e: e["key"] != "last")
    page = page.withColumn("_trades", F.from_json(F.get(named, 0)["value"], "array<array<string>>"))
    reason = (
        F.when(F.coalesce(F.size("_page.error"), F.lit(0)) > 0, "error")
        .when(F.col("_page.result").isNull(), "not a page")
        .when((F.size(named) > 0) & F.col("_trades").isNull(), "trades do not parse")
        .when(F.size("_trades") > MAX_TRADES_PER_PAGE, "too many trades"))
    return page.withColumns({"_cursor": F.col("_page.result")["last"], "_reason": reason})


def _page_trades(pages: DataFrame) -> DataFrame:
    """One row per raw trade of the pages that are not rejected, still as text."""
    return _opened(pages).filter("_reason IS NULL").select(
        "product_id", "request_no", F.posexplode("_trades").alias("position", "_raw"))


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Pages that give no trades because something is wrong with them, with the reason."""
    return _opened(pages).filter("_reason IS NOT NULL").select(
        "product_id", "request_no", F.col("_reason").alias("reason"), "body")


def _parsed(raw: DataFrame) -> DataFrame:
    number = [F.get("_raw", i).try_cast("double") for i in range(3)]
    return raw.select("product_id", "request_no", "position", "_raw",
                      number[0].alias("price"), number[1].alias("quantity"),
                      number[2].alias("_time"))


def _whole() -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("price", "quantity", "_time")])


def decode_pages(pages: DataFrame) -> DataFrame:
    """Trades from landed pages (product_id, request_no, body).

    `seq` numbers the trades of a product in the order they were fetched. Malformed trades
    are left out; `rejected_trades` returns them.
    """
    return _parsed(_page_trades(pages)).filter(_whole()).select(
        "product_id", "price", "quantity",
        seconds_to_iso("_time").alias("timestamp"),
        seconds_to_ms("_time").alias("timestamp_ms"),
        (F.col("request_no") * F.lit(MAX_TRADES_PER_PAGE) + F.col("position")).alias("seq"))


def rejected_trades(pages: DataFrame) -> DataFrame:
    """Raw trades whose price, volume or time is not a number."""
    return _parsed(_page_trades(pages)).filter(~_whole()).select(
        "product_id", "request_no", "position", F.to_json("_raw").alias("raw"))


def _message_trades(messages: DataFrame, body: str, arrival: str | None) -> DataFrame:
    """One row per trade of the live messages, with `reason` where it cannot be used.

    Heartbeats and status messages, told by their channel, hold no trades. A message that is no
    JSON, has no text or no array of data is one such row.
    """
    text = F.col(body).cast("string")
    number = F.lit(None).cast("bigint") if arrival is None else F.col(arrival).cast("bigint")
    opened = messages.select(
        text.alias("body"), number.alias("_arrival"), F.from_json(text, LIVE_MESSAGE).alias("m")).filter(
        ~F.coalesce(F.col("m.channel").isin(*NO_TRADES), F.lit(False)))
    broken = F.when(F.col("body").isNull(), "no text").when(
        F.col("m").isNull() | (F.col("m.channel").isNull() & F.col("m.data").isNull()), "not a message").when(
        F.col("m.data").isNull(), "no array of data")
    empty = F.array(F.lit(None).cast(LIVE_MESSAGE["data"].dataType.elementType))
    rows = opened.select("body", "_arrival", broken.alias("_broken"), F.posexplode(
        F.when(broken.isNotNull(), empty).otherwise(F.col("m.data"))).alias("position", "t"))
    ms = iso_to_ms(F.col("t.timestamp"))
    reason = (
        F.when(F.col("_broken").isNotNull(), F.col("_broken")).when(F.col("t.symbol").isNull(), "no product")
        .when(F.col("t.price").isNull() | F.col("t.qty").isNull(), "no price or quantity")
        .when(ms.isNull(), "no time").when(F.col("position") >= MAX_TRADES_PER_PAGE, "too many trades"))
    return rows.select(
        "body", "position", reason.alias("reason"), F.col("t.symbol").alias("product_id"),
        F.col("t.price").alias("price"), F.col("t.qty").alias("quantity"),
        F.col("t.timestamp").alias("timestamp"), ms.alias("timestamp_ms"),
        (F.col("_arrival") * F.lit(MAX_TRADES_PER_PAGE) + F.col("position")).alias("seq"))


def decode_messages(messages: DataFrame, body: str = "value", arrival: str | None = None) -> DataFrame:
    """Trades from live messages; heartbeats and status messages give none.

    With `arrival`, the messages' number (such as the topic offset), trades get a `seq` in the
    order of arrival. Keys are never NULL; `rejected_messages` returns what is left out.
    """
    rows = _message_trades(messages, body, arrival).filter("reason IS NULL").drop("body", "position", "reason")
    return rows.drop("seq") if arrival is None else rows


def rejected_messages(messages: DataFrame, body: str = "value") -> DataFrame:
    """Trades of live messages, or whole messages, that cannot be used, with the reason."""
    return _message_trades(messages, body, None).filter("reason IS NOT NULL").select("position", "reason", "body")


def page_summary(pages: DataFrame) -> DataFrame:
    """Per page: number of trades and the cursor for the next one.

    A page with an error has 0 trades; of a page that does not parse the number is unknown.
    """
    failed = F.col("_reason") == "error"
    return _opened(pages).select(
        "product_id", "request_no",
        F.when(failed, F.lit(0)).when(F.col("_reason").isNull(), F.coalesce(F.size("_trades"), F.lit(0)))
        .alias("trades"),
        F.when(~F.coalesce(failed, F.lit(False)), F.col("_cursor")).alias("cursor"))


def page_audit(pages: DataFrame) -> DataFrame:
    """Pages at which fetching has to stop: the cursor repeats, or it is the third empty
    page in a row. `pages` holds product_id, request_no, trades and cursor; a page with an
    unknown number of trades is not an empty one."""
    key = ["product_id"]
    cell = time_cell("request_no", PAGE_CELL)
    filled, w = with_halo(number_rows(pages.filter("trades > 0"), key, ["request_no"], cell),
                          key, before=1)
    stalled = drop_halo(filled.withColumn("_was", F.lag("cursor").over(w))).filter(
        "cursor = _was").select("product_id", "request_no", F.lit("cursor_not_moving").alias("problem"))
    every, w = with_halo(number_rows(pages, key, ["request_no"], cell), key, before=2)
    run = F.max(F.coalesce("trades", F.lit(1))).over(w.rowsBetween(-2, 0))
    empty = drop_halo(every.withColumn("_most", run)).filter("_most = 0 AND rn >= 3").select(
        "product_id", "request_no", F.lit("three_empty_pages").alias("problem"))
    return stalled.unionByName(empty)
