"""Declared schemas. Nothing in the library is inferred from data."""

from pyspark.sql import types as T

# The nine wire fields of one trade message, in wire order, and
# the case-distinct name each one has inside the library.
WIRE_FIELDS = [
    ("e", "event_kind", T.StringType()),
    ("E", "event_ms", T.LongType()),
    ("s", "symbol", T.StringType()),
    ("t", "trade_id", T.LongType()),
    ("p", "price", T.StringType()),
    ("q", "qty", T.StringType()),
    ("T", "trade_ms", T.LongType()),
    ("m", "is_maker", T.BooleanType()),
    ("M", "ignore_flag", T.BooleanType()),
]

CORRUPT = "_corrupt_record"

RAW_TRADE = T.StructType([T.StructField(wire, kind) for wire, _, kind in WIRE_FIELDS])
TRADE = T.StructType([T.StructField(name, kind) for _, name, kind in WIRE_FIELDS])
ENVELOPE = T.StructType(
    [T.StructField("stream", T.StringType()), T.StructField("data", RAW_TRADE)]
)

SILVER = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("trade_time", T.TimestampType()),
        T.StructField("trade_time_ms", T.LongType()),
        T.StructField("is_maker", T.BooleanType()),
        T.StructField("trade_id", T.LongType()),
    ]
)

# What the lake and the warehouse keep of silver.
SILVER_PUBLISHED = ["symbol", "price", "quantity", "event_time", "trade_time", "is_maker"]

ANOMALY = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("anomaly_type", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("direction", T.StringType()),
        T.StructField("metric", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("window_sec", T.IntegerType()),
        T.StructField("trade_id", T.LongType()),
        T.StructField("trade_time", T.TimestampType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("trade_count", T.LongType()),
        T.StructField("buy_volume", T.DoubleType()),
        T.StructField("sell_volume", T.DoubleType()),
        T.StructField("gap_ms", T.LongType()),
        T.StructField("details", T.StringType()),
    ]
)

PARTITIONS = ["dt", "hour_bucket"]
PARTITION_FIELDS = [T.StructField(name, T.StringType()) for name in PARTITIONS]

BRONZE_LAKE = T.StructType([T.StructField("value", T.StringType()), *PARTITION_FIELDS])
SILVER_LAKE = T.StructType([*(SILVER[c] for c in SILVER_PUBLISHED), *PARTITION_FIELDS])
ANOMALY_LAKE = T.StructType([*ANOMALY.fields, *PARTITION_FIELDS])
