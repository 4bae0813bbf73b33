"""Decode raw records; a malformed record is set aside and never stops the rest of its batch.

Every function is a row-local plan: no shuffle, usable on batch and streaming DataFrames alike.
At scale decode once, keep the result as parquet (``tables.write_decoded``) and let each operator
read only the columns it touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter import schemas

_CORRUPT = "_corrupt"
_MARK = "_mark"


def parse(raw: DataFrame, message: T.StructType) -> DataFrame:
    """Raw columns plus ``message`` (struct) and ``malformed`` (boolean) for every record.

    A record is malformed unless its payload is exactly one JSON object whose fields have the right
    types. The payload is parsed once, as the middle one of three array elements; the others hold the payload's
    hash, so neither text after the message nor a second message goes unnoticed.
    The parsed struct passes through a one-element ``inline`` so that a filter on the result
    is not pushed below the parser, which would read every payload twice.
    """
    text = F.col("payload").cast("string")
    mark = F.concat(F.lit(f'{{"{_MARK}":'), F.xxhash64(text).cast("string"), F.lit("}"))
    wrapped = F.concat(F.lit('{"m":['), mark, F.lit(","), text, F.lit(","), mark, F.lit("]}"))
    element = T.StructType([*message.fields, T.StructField(_MARK, T.LongType())])
    outer = T.StructType([T.StructField("m", T.ArrayType(element)), T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(wrapped, outer, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    before, body, after = (F.get("parsed.m", F.lit(i)) for i in range(3))
    marked = (before[_MARK] == F.xxhash64(text)) & (after[_MARK] == F.xxhash64(text))
    good = (F.size("parsed.m") == 3) & marked & body.isNotNull() & F.col(f"parsed.{_CORRUPT}").isNull()
    columns = ["shard_id", "sequence_number", "arrival_ms", "payload"]
    fields = F.struct(*[body[name].alias(name) for name in message.names])
    return raw.select(*columns, F.inline(F.array(F.struct(parsed.alias("parsed"))))).select(
        *columns, F.when(body.isNotNull(), fields).alias("message"), (~F.coalesce(good, F.lit(False))).alias("malformed")
    )


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where("malformed").select("shard_id", "sequence_number", "arrival_ms", "payload")


def sense_messages(parsed: DataFrame) -> DataFrame:
    """Well-formed sense messages, flat. Fields read without a presence test get their default."""
    return parsed.where("NOT malformed").select(
        "shard_id",
        "sequence_number",
        "arrival_ms",
        F.coalesce("message.data.device_id", F.lit("")).alias("device_id"),
        F.coalesce("message.uptime_in_second", F.lit(0)).alias("uptime_seconds"),
        F.coalesce("message.received_at", F.lit(0)).cast("long").alias("received_at"),
        F.col("message.firmware_top_version").alias("top_version"),
        F.coalesce("message.firmware_middle_version", F.lit("")).alias("middle_version"),
        F.col("message.data.firmware_version").alias("batch_firmware"),
        F.col("message.data.connected_ssid").alias("connected_ssid"),
        F.col("message.data.scan").alias("scan"),
        F.col("message.data.data").alias("points"),
    )


def pill_messages(parsed: DataFrame) -> DataFrame:
    return parsed.where("NOT malformed").select(
        "shard_id", "sequence_number", "arrival_ms", F.col("message.pills").alias("pills")
    )


def sense_points(messages: DataFrame, *keep: str) -> DataFrame:
    """One row per data point: the ``keep`` columns of the message, ``position`` and ``point``."""
    return messages.select(*keep, F.posexplode("points").alias("position", "point"))


def pill_readings(messages: DataFrame) -> DataFrame:
    """One row per pill reading; ``seen_at`` in epoch ms."""
    return messages.select(
        "shard_id", "sequence_number", "arrival_ms", F.posexplode("pills").alias("position", "pill")
    ).select(
        "shard_id",
        "sequence_number",
        "arrival_ms",
        "position",
        F.coalesce("pill.device_id", F.lit("")).alias("device_id"),
        (F.coalesce("pill.timestamp", F.lit(0)).cast("long") * 1000).alias("seen_at"),
    )


def decode_sense(raw: DataFrame) -> DataFrame:
    return sense_messages(parse(raw, schemas.SENSE_MESSAGE))


def decode_pill(raw: DataFrame) -> DataFrame:
    return pill_messages(parse(raw, schemas.PILL_MESSAGE))
