"""Latest state of every device and the hourly active-device sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions import clock, wifi
from fleetmeter.functions.arrival import arrival
from fleetmeter.operators.latest import reduce_latest

SENSE_STATE = ["received_at", "uptime_seconds", "ssid", "rssi"]


def sense_state_rows(messages: DataFrame) -> DataFrame:
    """Key, arrival and state columns of every message, ready to be reduced."""
    return messages.select(
        "device_id",
        arrival().alias("arrival"),
        "received_at",
        "uptime_seconds",
        wifi.ssid().alias("ssid"),
        wifi.rssi().alias("rssi"),
    )


def sense_state(messages: DataFrame) -> DataFrame:
    """Activity, uptime and network of every device in one pass over the messages."""
    return reduce_latest(sense_state_rows(messages), ["device_id"], SENSE_STATE)


def active_senses(messages: DataFrame) -> DataFrame:
    return reduce_latest(sense_state_rows(messages), ["device_id"], ["received_at"]).drop("arrival")


def sense_uptimes(messages: DataFrame) -> DataFrame:
    return reduce_latest(sense_state_rows(messages), ["device_id"], ["uptime_seconds"]).drop("arrival")


def with_wifi_text(state: DataFrame) -> DataFrame:
    return state.select("device_id", "ssid", "rssi", wifi.text().alias("wifi_text"), wifi.known().alias("known"))


def wifi_info(messages: DataFrame) -> DataFrame:
    """The text is formatted after the reduction, once per device."""
    return with_wifi_text(reduce_latest(sense_state_rows(messages), ["device_id"], ["ssid", "rssi"]))


def pill_state(readings: DataFrame) -> DataFrame:
    rows = readings.select("device_id", arrival("position").alias("arrival"), "seen_at")
    return reduce_latest(rows, ["device_id"], ["seen_at"])


def active_pills(readings: DataFrame) -> DataFrame:
    return pill_state(readings).drop("arrival")


def active_hours(rows: DataFrame, clock_column: str) -> DataFrame:
    """Distinct (hour, device), the hour as its start in epoch ms."""
    hour = clock.floor_ms(F.col(clock_column), clock.HOUR_MS)
    return rows.select(hour.alias("hour_start"), "device_id").distinct()


def with_hour_key(hours: DataFrame) -> DataFrame:
    """Key text and expiry of each member; formatted after the distinct."""
    return hours.select(
        clock.hour_key(F.col("hour_start")).alias("hour_key"),
        "device_id",
        clock.hour_expiry(F.col("hour_start")).alias("expire_at"),
    )


def hourly_active_sense(messages: DataFrame) -> DataFrame:
    return with_hour_key(active_hours(messages, "arrival_ms"))


def hourly_active_pill(readings: DataFrame) -> DataFrame:
    return with_hour_key(active_hours(readings, "arrival_ms"))


# -- the hourly sets of a device as a ring of bits ----------------------------------------------

# Fixed value: an hourly set outlives its hour's start by as many hours.
RING_HOURS = clock.HOURLY_SET_TTL_SECONDS // 3600


def hour_rings(rows: DataFrame, clock_column: str) -> DataFrame:
    """device_id, top_hour (hours since the epoch) and hours, whose bit i says "active in hour top_hour - i"."""
    hour = F.call_function("div", F.col(clock_column), F.lit(clock.HOUR_MS))
    return merge_rings(rows.select("device_id", hour.alias("top_hour"), F.lit(1).cast("long").alias("hours")))


def merge_rings(rings: DataFrame) -> DataFrame:
    """Rings of the same top hour in one; associative and idempotent."""
    return rings.groupBy("device_id", "top_hour").agg(F.bit_or("hours").alias("hours"))


def turn_rings(rings: DataFrame, hour: int) -> DataFrame:
    """All rings as of ``hour``: bits move up by the hours that have passed and fall out after ``RING_HOURS``.

    One row per device; a device that is ahead of ``hour`` keeps those rings apart.
    """
    age = F.greatest(F.lit(hour) - F.col("top_hour"), F.lit(0))
    shifted = F.call_function("shiftleft", "hours", F.least(age, F.lit(RING_HOURS)).cast("int"))
    top = F.greatest("top_hour", F.lit(hour).cast("long"))
    turned = rings.select("device_id", top.alias("top_hour"), shifted.bitwiseAND((1 << RING_HOURS) - 1).alias("hours"))
    return merge_rings(turned.where(F.col("hours") != 0))


def ring_hours(rings: DataFrame, as_of_ms: int) -> DataFrame:
    """The live members at ``as_of_ms`` as (hour_start, device_id)."""
    last = as_of_ms // clock.HOUR_MS
    set_bits = F.filter(
        F.sequence(F.lit(0), F.lit(RING_HOURS - 1)),
        lambda i: F.call_function("shiftright", F.col("hours"), i).bitwiseAND(1) == 1,
    )
    bits = turn_rings(rings, last).select("device_id", "top_hour", F.explode(set_bits).alias("age"))
    hours = bits.select("device_id", (F.col("top_hour") - F.col("age")).alias("hour"))
    return hours.where(F.col("hour") > last - RING_HOURS).select((F.col("hour") * clock.HOUR_MS).alias("hour_start"), "device_id")


def live(hourly: DataFrame, as_of_seconds: Column | int) -> DataFrame:
    """Hourly sets that have not expired at ``as_of_seconds``; also the purge rule of the store."""
    as_of = as_of_seconds if isinstance(as_of_seconds, Column) else F.lit(as_of_seconds)
    return hourly.where(F.col("expire_at") > as_of)
