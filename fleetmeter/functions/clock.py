"""Time expressions. All times are epoch numbers in UTC; text forms need a UTC session time zone."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MINUTE_MS = 60_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000

# Hourly sets live for 48 hours, counted from the start of their hour.
HOURLY_SET_TTL_SECONDS = 48 * 3600


def utc_session(spark: SparkSession) -> SparkSession:
    """Pin the session time zone; the zone is bound when an expression is analysed."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def floor_ms(ms: Column, width_ms: int) -> Column:
    """Start of the aligned bucket of ``width_ms`` that holds ``ms``."""
    return ms - F.pmod(ms, F.lit(width_ms))


def seconds_to_ms(seconds: Column) -> Column:
    return F.coalesce(seconds, F.lit(0)).cast("long") * F.lit(1000)


def hour_key(hour_start_ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(hour_start_ms), "yyyy_MM_dd_HH_00")


def hour_expiry(hour_start_ms: Column) -> Column:
    """Expiry of an hourly set in epoch seconds."""
    return F.call_function("div", hour_start_ms, F.lit(1000)) + F.lit(HOURLY_SET_TTL_SECONDS)


def created_at(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ssZ")


def whole_days(seconds: Column) -> Column:
    """Whole days in a number of seconds, truncated toward zero in integer arithmetic."""
    return F.call_function("div", seconds, F.lit(86_400)).cast("int")
