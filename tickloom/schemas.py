"""Record types of the data model."""

from pyspark.sql import types as T

PERIODS = (7, 14, 21, 60)

TRADE = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("timestamp_ms", T.LongType()),
])

CANDLE = T.StructType([
    T.StructField("pair", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("window_start_ms", T.LongType()),
    T.StructField("window_end_ms", T.LongType()),
    T.StructField("window_in_sec", T.IntegerType()),
])

INDICATOR_KINDS = ("sma", "ema", "rsi", "adx", "macd", "macdsignal", "macdhist")


def indicator_columns(periods=PERIODS) -> list[str]:
    """Indicator columns in the order of the feature table."""
    return [f"{kind}_{p}" for p in periods for kind in INDICATOR_KINDS] + ["obv"]


def feature_schema(periods=PERIODS) -> T.StructType:
    """The keyed feature table: candle columns, indicators, creation time."""
    fields = list(CANDLE.fields)
    fields += [T.StructField(c, T.DoubleType()) for c in indicator_columns(periods)]
    fields.append(T.StructField("created_at", T.TimestampType()))
    return T.StructType(fields)


LIVE_MESSAGE = T.StructType([
    T.StructField("channel", T.StringType()),
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("qty", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
    ]))),
])

TRADE_PAGE = T.StructType([
    T.StructField("error", T.ArrayType(T.StringType())),
    T.StructField("result", T.MapType(T.StringType(), T.StringType())),
])

REGISTRY = T.StructType([
    T.StructField("pair", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("horizon", T.IntegerType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("feature_columns", T.ArrayType(T.StringType())),
])
