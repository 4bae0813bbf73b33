"""State tables under their store names: (key, field, value), every value as text.

``active_*``, ``*_seen``, ``middle:``, ``top:`` are scores of members; ``wifi_info``,
``sense_uptimes`` and ``device_id:`` are fields of hashes; an hourly set has members without a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions import wifi
from fleetmeter.operators import firmware
from fleetmeter.operators.latest import reduce_latest


def entries(table: DataFrame, key: Column | str, field: Column | str, value: Column) -> DataFrame:
    key = F.lit(key) if isinstance(key, str) else key
    field = F.col(field) if isinstance(field, str) else field
    return table.select(key.alias("key"), field.alias("field"), value.cast("string").alias("value"))


def device_hash(device_firmware: DataFrame) -> DataFrame:
    """``device_id:<id>`` with only the fields that were ever written."""
    fields = ("middle_version", "top_version", "timestamp")
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    return device_firmware.select(
        F.concat(F.lit("device_id:"), F.col("device_id")).alias("key"), F.inline(pairs)
    ).where("value IS NOT NULL")


def hourly_set(hourly: DataFrame, prefix: str) -> DataFrame:
    return entries(hourly, F.concat(F.lit(prefix), F.col("hour_key")), "device_id", F.lit(None))


def sense_export(sense_state: DataFrame, version_state: DataFrame) -> DataFrame:
    """All sense keys except the hourly sets, from the two reduced state tables."""
    device = sense_state.select(
        "device_id",
        F.inline(
            F.array(
                F.struct(F.lit("active_senses").alias("key"), F.col("received_at").cast("string").alias("value")),
                F.struct(F.lit("sense_uptimes").alias("key"), F.col("uptime_seconds").cast("string").alias("value")),
                F.struct(F.lit("wifi_info").alias("key"), wifi.text().alias("value")),
            )
        ),
    ).select("key", F.col("device_id").alias("field"), "value")
    members = entries(
        version_state, F.concat("part", F.lit(":"), "version"), "device_id", F.col("timestamp")
    )
    seen_key = F.when(F.col("part") == "middle", "firmwares_seen").otherwise("top_firmwares_seen")
    seen = reduce_latest(version_state, ["part", "version"], ["timestamp"])
    return (
        device.unionByName(members)
        .unionByName(entries(seen, seen_key, "version", F.col("timestamp")))
        .unionByName(device_hash(firmware.device_firmware_view(version_state)))
    )
