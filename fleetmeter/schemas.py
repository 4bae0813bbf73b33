"""Column layouts of the raw streams, the message payloads and the decoded tables."""

from __future__ import annotations

from pyspark.sql import types as T

# A raw stream, batch or streaming: one row per record of a shard. ``sequence_number`` is a digit
# string of any length; ``arrival_ms`` is the processing clock of the record.
RAW = T.StructType([
    T.StructField("shard_id", T.StringType()),
    T.StructField("sequence_number", T.StringType()),
    T.StructField("arrival_ms", T.LongType()),
    T.StructField("payload", T.StringType()),
])

SCAN_ENTRY = T.StructType([
    T.StructField("ssid", T.StringType()),
    T.StructField("rssi", T.IntegerType()),
])

SENSE_POINT = T.StructType([
    T.StructField("unix_time", T.LongType()),
    T.StructField("wave_count", T.IntegerType()),
    T.StructField("co2", T.IntegerType()),
    T.StructField("pressure", T.IntegerType()),
    T.StructField("light_sensor", T.StructType([T.StructField("uv_count", T.IntegerType())])),
    T.StructField("light", T.IntegerType()),
    T.StructField("dust", T.IntegerType()),
    T.StructField("humidity", T.IntegerType()),
    T.StructField("temperature", T.IntegerType()),
    T.StructField("firmware_version", T.IntegerType()),
])

SENSE_MESSAGE = T.StructType([
    T.StructField("ip_address", T.StringType()),
    T.StructField("uptime_in_second", T.IntegerType()),
    T.StructField("received_at", T.LongType()),
    T.StructField("firmware_top_version", T.StringType()),
    T.StructField("firmware_middle_version", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("device_id", T.StringType()),
        T.StructField("firmware_version", T.IntegerType()),
        T.StructField("connected_ssid", T.StringType()),
        T.StructField("scan", T.ArrayType(SCAN_ENTRY)),
        T.StructField("data", T.ArrayType(SENSE_POINT)),
    ])),
])

PILL_READING = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

PILL_MESSAGE = T.StructType([T.StructField("pills", T.ArrayType(PILL_READING))])

# The position index: hash key, range key, stored value.
CHECKPOINT_TRACK = T.StructType([
    T.StructField("stream_shard_id", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("checkpoint", T.StringType()),
])
