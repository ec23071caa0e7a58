"""Scalar conversions between milliseconds, timestamps, dates and names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def window_start(ms, width_ms: int) -> Column:
    """Start of the epoch-aligned window holding `ms` (start inclusive, end exclusive)."""
    return _c(ms) - F.pmod(_c(ms), F.lit(width_ms).cast("bigint"))


def whole_second(ms) -> Column:
    """Timestamp of the whole second: fractions are cut by the integer division."""
    return F.timestamp_seconds(F.floor(_c(ms) / F.lit(1000)).cast("bigint"))


def trading_date(ms) -> Column:
    return F.to_date(whole_second(ms))


def event_time(ms) -> Column:
    return F.timestamp_millis(_c(ms))


def iso_to_ms(text) -> Column:
    """ISO text with zone to epoch milliseconds; NULL when it does not parse."""
    return F.unix_millis(F.try_to_timestamp(_c(text)))


def seconds_to_ms(seconds) -> Column:
    """Epoch seconds to milliseconds, cut towards zero."""
    return (_c(seconds) * F.lit(1000)).cast("bigint")


def seconds_to_cursor(seconds) -> Column:
    """Epoch seconds to the text cursor in nanoseconds used for paging."""
    return (_c(seconds) * F.lit(1_000_000_000)).cast("bigint").cast("string")


def seconds_to_iso(seconds) -> Column:
    """Epoch seconds to ISO text in UTC; the fraction appears only when it is not zero."""
    micros = F.round(_c(seconds) * F.lit(1_000_000)).cast("bigint")
    at = F.timestamp_micros(micros)
    return F.when(
        F.pmod(micros, F.lit(1_000_000)) == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def registered_name(pair, model, horizon) -> Column:
    """Registry name `pair_model_horizon`, with the slash of the pair replaced."""
    return F.concat_ws("_", F.replace(_c(pair), F.lit("/"), F.lit("_")), _c(model),
                       _c(horizon).cast("string"))


def present(column) -> Column:
    """The value, with NaN turned into NULL."""
    return F.when(~F.isnan(_c(column)), _c(column))
