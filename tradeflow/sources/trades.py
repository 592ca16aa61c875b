"""Trade messages: read, unwrap, parse and publish.

Everything here works on a static and on a streaming DataFrame of messages with
one text (or binary) column ``value``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.config import PipelineConfig
from tradeflow.functions.columns import computed_once, stream_name
from tradeflow.schema import CORRUPT, ENVELOPE, RAW_TRADE, TRADE, WIRE_FIELDS


def _with_corrupt(*fields: T.StructField) -> T.StructType:
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def _parsed(messages: DataFrame, wire: T.StructType, named: T.StructType) -> DataFrame:
    """``message`` (the text) and ``parsed``, each message parsed once.

    The cast from ``wire`` to ``named`` renames by position: the wire names
    differ only by case and cannot be told apart by name.
    """
    parsed = (
        f"CAST(from_json(message, '{wire.simpleString()}',"
        f" map('columnNameOfCorruptRecord', '{CORRUPT}')) AS {named.simpleString()})"
    )
    return computed_once(messages.selectExpr("CAST(value AS string) AS message"), parsed=parsed)


_MALFORMED = f"(parsed IS NULL OR parsed.{CORRUPT} IS NOT NULL)"


def _trades(parsed: DataFrame, struct: str) -> DataFrame:
    return parsed.select(*(f"{struct}.{name}" for name in TRADE.fieldNames())).withColumn(
        "event_time", F.timestamp_millis("event_ms")
    )


def judge_messages(messages: DataFrame) -> DataFrame:
    """Every bare trade message with its text, its trade, and why it is rejected.

    ``reason`` is null for a good message. The text is parsed once for all that is
    made of it: bronze, silver and rejects. Trade fields of rejects mean nothing.
    """
    parsed = _parsed(messages, _with_corrupt(*RAW_TRADE.fields), _with_corrupt(*TRADE.fields))
    return parsed.selectExpr(
        "message",
        f"IF({_MALFORMED}, 'bad_json', NULL) AS reason",
        *(f"parsed.{name} AS {name}" for name in TRADE.fieldNames()),
        "timestamp_millis(parsed.event_ms) AS event_time",
    )


def good_trades(judged: DataFrame) -> DataFrame:
    return judged.where("reason IS NULL").select(*TRADE.fieldNames(), "event_time")


def rejects(judged: DataFrame) -> DataFrame:
    """The messages that were rejected, as they came, with the reason."""
    return judged.where("reason IS NOT NULL").select("message", "reason")


def parse_trades(messages: DataFrame) -> DataFrame:
    """Trades out of bare trade messages; ``parse_rejects`` has the malformed ones."""
    return good_trades(judge_messages(messages))


def parse_rejects(messages: DataFrame) -> DataFrame:
    """The messages ``parse_trades`` leaves out, with the reason."""
    return rejects(judge_messages(messages))


def judge_envelopes(messages: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Every ``{"stream", "data"}`` message with its data as text, untouched.

    ``reason`` is null for a message to publish, else ``bad_json``, ``no_data``,
    ``empty_data``, ``no_object`` (data of another kind) or, with a ``universe`` of
    symbols, ``not_subscribed``: its stream is none of theirs. Fields that the library
    does not know, and trades without a symbol, pass.
    """
    wire = "struct<stream:string,data:string,_corrupt_record:string>"
    text = (
        f"from_json(message, '{wire}', map('columnNameOfCorruptRecord', '{CORRUPT}'))"
    )
    parsed = computed_once(messages.selectExpr("CAST(value AS string) AS message"), parsed=text)
    judged = parsed.selectExpr(
        "message",
        "parsed.stream AS stream",
        "parsed.data AS value",
        f"""CASE WHEN {_MALFORMED} THEN 'bad_json'
                 WHEN parsed.data IS NULL THEN 'no_data'
                 WHEN parsed.data IN ('{{}}', '[]', '', '0', 'false') THEN 'empty_data'
                 WHEN parsed.data NOT LIKE '{{%' THEN 'no_object' END AS reason""",
    )
    if universe is None:
        return judged
    wanted = universe.select(stream_name().alias("wanted")).distinct()
    known = judged.join(wanted, F.lower("stream") == F.col("wanted"), "left")
    return known.selectExpr(
        "message", "stream", "value",
        "coalesce(reason, IF(wanted IS NULL, 'not_subscribed', NULL)) AS reason",
    )


def published(judged: DataFrame) -> DataFrame:
    """The data of good envelopes, as text to publish."""
    return judged.where("reason IS NULL").select("value")


def unwrap_envelope(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split ``{"stream", "data"}`` messages into trades and rejects.

    Rejects keep their text and say why: ``bad_json``, ``no_data`` or
    ``empty_data`` (``data`` is there but holds none of a trade's fields).
    """
    named = [T.StructField("stream", T.StringType()), T.StructField("data", TRADE)]
    parsed = _parsed(messages, _with_corrupt(*ENVELOPE.fields), _with_corrupt(*named))
    values = ", ".join(f"CAST(parsed.data.{name} AS string)" for name in TRADE.fieldNames())
    judged = parsed.selectExpr(
        "*",
        f"""CASE WHEN {_MALFORMED} THEN 'bad_json'
                 WHEN parsed.data IS NULL THEN 'no_data'
                 WHEN coalesce({values}) IS NULL THEN 'empty_data' END AS reason""",
    )
    return (
        _trades(judged.where("reason IS NULL"), "parsed.data"),
        judged.where("reason IS NOT NULL").select("message", "reason"),
    )


def _wire() -> Column:
    return F.struct(*(F.col(name).alias(wire) for wire, name, _ in WIRE_FIELDS))


def message_text() -> Column:
    """A trade as wire JSON text."""
    return F.to_json(_wire(), {"ignoreNullFields": "false"})


def publish_trades(trades: DataFrame) -> DataFrame:
    """Trades as wire JSON text in ``value``, without a key."""
    return trades.select(message_text().alias("value"))


def envelope_text() -> Column:
    """A trade as the exchange sends it."""
    envelope = F.struct(stream_name().alias("stream"), _wire().alias("data"))
    return F.to_json(envelope, {"ignoreNullFields": "false"})


def kafka_options(cfg: PipelineConfig) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": cfg.kafka_servers,
        "subscribe": cfg.kafka_topic,
        "startingOffsets": "earliest",
    }
    if cfg.max_offsets_per_trigger:  # 0: no bound
        options["maxOffsetsPerTrigger"] = str(cfg.max_offsets_per_trigger)
    return options


def read_messages(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """A stream of messages from the configured folder, or else from Kafka."""
    if cfg.source_path is None:
        reader = spark.readStream.format("kafka").options(**kafka_options(cfg))
        return reader.load().select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text")
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    return reader.load(cfg.source_path)


def read_trades(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """The trade stream with its event time and watermark."""
    return parse_trades(read_messages(spark, cfg)).withWatermark("event_time", cfg.watermark)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Several feeds of one shape as one."""
    return reduce(DataFrame.unionByName, feeds)
