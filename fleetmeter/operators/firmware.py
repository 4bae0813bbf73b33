"""Firmware of messages and devices, and the version tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions.arrival import arrival
from fleetmeter.functions.clock import seconds_to_ms
from fleetmeter.operators.latest import reduce_latest

# Fixed value: the version text that stands for "not known".
UNKNOWN = "0"


def _has_top():
    return F.col("top_version").isNotNull() & (F.col("top_version") != UNKNOWN)


def sense_firmware(messages: DataFrame) -> DataFrame:
    """One firmware per message.

    A usable top version makes the whole message (middle, top, received_at). Otherwise it is the
    newest point, ties to the greatest version text; a message without points gives no row. The
    points are reduced inside their row, without explode or shuffle, from the two fields that matter.
    """
    newest = F.array_max(
        F.zip_with(
            "points.unix_time",
            "points.firmware_version",
            lambda time, version: F.struct(
                seconds_to_ms(time).alias("timestamp"),
                F.coalesce(F.col("batch_firmware"), version, F.lit(0)).cast("string").alias("version"),
            ),
        )
    )
    firmware = F.when(
        _has_top(),
        F.struct(
            F.col("middle_version").alias("middle_version"),
            F.col("top_version").alias("top_version"),
            F.col("received_at").alias("timestamp"),
        ),
    ).otherwise(
        F.when(
            newest.isNotNull(),
            F.struct(
                newest.version.alias("middle_version"),
                F.lit(UNKNOWN).alias("top_version"),
                newest.timestamp.alias("timestamp"),
            ),
        )
    )
    return (
        messages.select("shard_id", "sequence_number", "device_id", F.inline(F.array(F.struct(firmware.alias("fw")))))
        .where("fw IS NOT NULL")
        .select("shard_id", "sequence_number", "device_id", "fw.*")
    )


def missing_top_firmware(messages: DataFrame) -> DataFrame:
    return messages.where(~_has_top()).select("shard_id", "sequence_number", "device_id")


# -- one table from a firmware stream, one pass each --------------------------------------------


def _set_at(value: str):
    return F.struct(arrival().alias("arrival"), F.col(value).alias("value"))


def device_firmware(firmware: DataFrame) -> DataFrame:
    """Latest middle and top of every device, taken independently, and when either was last set.

    A part that is not known is null for that message and leaves the older value in place; ``max``
    skips nulls. A device that never had a known part gives no row.
    """
    middle, top = F.col("middle_version") != UNKNOWN, F.col("top_version") != UNKNOWN
    return (
        firmware.where(middle | top)
        .groupBy("device_id")
        .agg(
            F.max(F.when(middle, _set_at("middle_version"))).alias("middle"),
            F.max(F.when(top, _set_at("top_version"))).alias("top"),
            F.max(_set_at("timestamp")).alias("stamp"),
        )
        .select(
            "device_id",
            F.col("middle.value").alias("middle_version"),
            F.col("top.value").alias("top_version"),
            F.col("stamp.value").alias("timestamp"),
        )
    )


def _known(firmware: DataFrame, part: str) -> DataFrame:
    return firmware.where(F.col(part) != UNKNOWN).withColumnRenamed(part, "version")


def _seen(firmware: DataFrame, part: str) -> DataFrame:
    """Per version the timestamp written last, whichever device it came from."""
    rows = _known(firmware, part).select("version", arrival().alias("arrival"), "timestamp")
    return reduce_latest(rows, ["version"], ["timestamp"]).drop("arrival")


def firmwares_seen(firmware: DataFrame) -> DataFrame:
    return _seen(firmware, "middle_version")


def top_firmwares_seen(firmware: DataFrame) -> DataFrame:
    return _seen(firmware, "top_version")


def _devices(firmware: DataFrame, part: str) -> DataFrame:
    """Per (version, device) the timestamp written last; rows of older versions stay."""
    rows = _known(firmware, part).select("version", "device_id", arrival().alias("arrival"), "timestamp")
    return reduce_latest(rows, ["version", "device_id"], ["timestamp"]).drop("arrival")


def middle_firmware_devices(firmware: DataFrame) -> DataFrame:
    return _devices(firmware, "middle_version")


def top_firmware_devices(firmware: DataFrame) -> DataFrame:
    return _devices(firmware, "top_version")


# -- all five tables from one reduced state -----------------------------------------------------

STATE_KEYS = ["part", "version", "device_id"]


def version_state(firmware: DataFrame) -> DataFrame:
    """Per (part, version, device): last arrival and its timestamp.

    One row per version a device ever ran. Every firmware table is a view of this one, so a job
    that needs several of them reads the messages once.
    """
    parts = F.array(
        F.struct(F.lit("middle").alias("part"), F.col("middle_version").alias("version")),
        F.struct(F.lit("top").alias("part"), F.col("top_version").alias("version")),
    )
    rows = firmware.select("device_id", arrival().alias("arrival"), "timestamp", F.inline(parts))
    return reduce_version_state(rows.where(F.col("version") != UNKNOWN))


def reduce_version_state(rows: DataFrame) -> DataFrame:
    return reduce_latest(rows, STATE_KEYS, ["timestamp"])


def device_firmware_view(state: DataFrame) -> DataFrame:
    rows = state.select(
        "device_id",
        F.when(F.col("part") == "middle", F.struct("arrival", "version")).alias("middle"),
        F.when(F.col("part") == "top", F.struct("arrival", "version")).alias("top"),
        F.struct("arrival", "timestamp").alias("stamp"),
    )
    return (
        rows.groupBy("device_id")
        .agg(F.max("middle").alias("middle"), F.max("top").alias("top"), F.max("stamp").alias("stamp"))
        .select(
            "device_id",
            F.col("middle.version").alias("middle_version"),
            F.col("top.version").alias("top_version"),
            F.col("stamp.timestamp").alias("timestamp"),
        )
    )


def seen_view(state: DataFrame, part: str) -> DataFrame:
    return reduce_latest(state.where(F.col("part") == part), ["version"], ["timestamp"]).drop("arrival")


def devices_view(state: DataFrame, part: str) -> DataFrame:
    return state.where(F.col("part") == part).select("version", "device_id", "timestamp")
