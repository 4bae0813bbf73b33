"""Fleet metrics: message volume, waves, low uptime, uptime distribution, rates and the report.

Meters are counted from *parsed* records (``decode.parse``), which still hold the malformed ones:
the volume meters include them. A parsed record yields one row per data point, or a single row
when it has none, so one scan feeds every meter; the first row of a record stands for the message.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions import clock, rules
from fleetmeter.operators.quality import meter_columns, unpivot

# A device is "low" up to one hour of uptime; distinct counts renew every hour.
LOW_UPTIME_SECONDS = 3600
# Quantiles of a reported histogram.
QUANTILES = {"p50": 0.5, "p75": 0.75, "p95": 0.95, "p98": 0.98, "p99": 0.99, "p999": 0.999}
# Sketches of 2**12 registers: a standard error of 1.6 %, half of what the described approximate set allows.
SKETCH_BITS = 12
# Hours of the periods that sketches are rolled up to; the name that stands for the whole stream.
SKETCH_PERIODS = (1, 24, 168)
ALL_SHARDS = "all"
# Averaging windows of a rate, in minutes; allowed reporting intervals, in seconds.
RATE_WINDOWS = (1, 5, 15)
REPORT_INTERVAL_SECONDS = (5, 120)


def messages_processed(raw: DataFrame) -> DataFrame:
    """All records, malformed ones included; payloads are not read."""
    return raw.agg(F.count(F.lit(1)).alias("messages"))


def wave_counts(messages: DataFrame) -> DataFrame:
    """Sum over all data points; only the wave counts are read from a stored table."""
    waves = messages.select(F.explode("points.wave_count").alias("wave_count"))
    return waves.agg(F.coalesce(F.sum(F.col("wave_count").cast("long")), F.lit(0).cast("long")).alias("wave_count"))


# -- low uptime --------------------------------------------------------------------------------


def low_uptime_first(messages: DataFrame) -> DataFrame:
    """Each (shard, hour, device) that reported a low uptime, with its first arrival; associative."""
    hour = clock.floor_ms(F.col("arrival_ms"), clock.HOUR_MS)
    rows = messages.where(F.col("uptime_seconds") <= LOW_UPTIME_SECONDS).select(
        "shard_id", hour.alias("hour_start"), "device_id", F.col("arrival_ms").alias("first_ms")
    )
    return reduce_low_uptime(rows)


def reduce_low_uptime(rows: DataFrame) -> DataFrame:
    return rows.groupBy("shard_id", "hour_start", "device_id").agg(F.min("first_ms").alias("first_ms"))


def low_uptime_devices(messages: DataFrame) -> DataFrame:
    """Exact distinct devices per shard and hour."""
    return (
        low_uptime_first(messages).groupBy("shard_id", "hour_start").agg(F.count(F.lit(1)).alias("devices"))
    )


def low_uptime_sketches(messages: DataFrame) -> DataFrame:
    """Per shard and hour a sketch of its low-uptime devices: a few kilobytes to store, whatever the fleet."""
    hour = clock.floor_ms(F.col("arrival_ms"), clock.HOUR_MS)
    low = messages.where(F.col("uptime_seconds") <= LOW_UPTIME_SECONDS)
    return low.groupBy("shard_id", hour.alias("hour_start")).agg(F.hll_sketch_agg("device_id", SKETCH_BITS).alias("sketch"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """Associative and idempotent: a device that is in two sketches counts once."""
    return sketches.groupBy("shard_id", "hour_start").agg(F.hll_union_agg("sketch").alias("sketch"))


def sketched_devices(sketches: DataFrame) -> DataFrame:
    """Estimated distinct devices per period (hour, day, week) of each shard and of all shards, from the stored sketches."""
    hours = F.explode(F.array(*[F.lit(h).cast("long") for h in SKETCH_PERIODS])).alias("period_hours")
    shards = F.explode(F.array("shard_id", F.lit(ALL_SHARDS))).alias("shard_id")
    rows = sketches.select("hour_start", "sketch", "shard_id", hours).select("hour_start", "sketch", "period_hours", shards)
    start = F.col("hour_start") - F.pmod(F.col("hour_start"), F.col("period_hours") * clock.HOUR_MS)
    return rows.groupBy("shard_id", "period_hours", start.alias("period_start")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("devices")
    )


def low_uptime_devices_approx(messages: DataFrame) -> DataFrame:
    return sketched_devices(low_uptime_sketches(messages))


# -- uptime distribution -----------------------------------------------------------------------


def uptime_histogram(messages: DataFrame, *keys: str) -> DataFrame:
    """Messages per whole day of uptime; an int of seconds has fewer than 25,000 whole days."""
    days = clock.whole_days(F.col("uptime_seconds")).alias("days")
    return messages.groupBy(*keys, days).agg(F.count(F.lit(1)).alias("n"))


def distribution(histogram: DataFrame, *keys: str) -> DataFrame:
    """Exact statistics of a histogram of (days, n), weighted by n."""
    days, n = F.col("days").cast("decimal(5,0)"), F.col("n").cast("decimal(18,0)")
    total, first, second = F.sum(n), F.sum(days * n), F.sum(days * days * n)
    mean = first.cast("double") / total.cast("double")
    # Sample deviation from exact sums: (N * sum(n d^2) - sum(n d)^2) / (N * (N - 1)).
    spread = (total * second - first * first).cast("double")
    deviation = F.when(total > 1, F.sqrt(spread / (total * (total - 1)).cast("double")))
    return histogram.groupBy(*keys).agg(
        total.cast("long").alias("messages"),
        F.min("days").alias("min_days"),
        F.max("days").alias("max_days"),
        F.round(mean, 6).alias("mean_days"),
        F.round(deviation, 6).alias("stddev_days"),
        *[F.round(F.percentile("days", F.lit(q), F.col("n")), 6).alias(p) for p, q in QUANTILES.items()],
    )


def uptime_days(messages: DataFrame) -> DataFrame:
    return distribution(uptime_histogram(messages))


# -- meters over time --------------------------------------------------------------------------

SENSE_METERS = ("messages-processed", "wave-counts", *rules.METERS)


def _named(names: Iterable[str], prefix: str) -> list[str]:
    return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]


def sense_meters(parsed: DataFrame, width_ms: int, names: Iterable[str] = SENSE_METERS) -> DataFrame:
    """Events per meter and bucket of arrival time: (metric, window_start, events).

    Wide conditional sums first, so a row is read once for all meters and partials stay small.
    """
    names = list(names)
    columns: dict[str, Column] = {
        "messages-processed": F.count_if(F.coalesce("position", F.lit(0)) == 0),
        "wave-counts": F.coalesce(F.sum(F.coalesce("point.wave_count", F.lit(0)).cast("long")), F.lit(0).cast("long")),
        **meter_columns(),
    }
    bucket = clock.floor_ms(F.col("arrival_ms"), width_ms).alias("window_start")
    points = F.when(~F.col("malformed"), F.col("message.data.data"))
    wide = (
        parsed.select(bucket, F.posexplode_outer(points).alias("position", "point"))
        .groupBy("window_start")
        .agg(*[columns[n].alias(f"sense.{n}") for n in names])
    )
    return unpivot(wide, ["window_start"], [f"sense.{n}" for n in names], "metric", "events").where("events > 0")


def low_uptime_meter(first: DataFrame, width_ms: int) -> DataFrame:
    bucket = clock.floor_ms(F.col("first_ms"), width_ms).alias("window_start")
    return (
        first.groupBy(bucket)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.lit("sense.low-uptime").alias("metric"), "window_start", "events")
    )


def pill_meters(raw: DataFrame, width_ms: int) -> DataFrame:
    bucket = clock.floor_ms(F.col("arrival_ms"), width_ms).alias("window_start")
    return (
        raw.groupBy(bucket)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.lit("pill.messages-processed").alias("metric"), "window_start", "events")
    )


def meter_events(
    sense_parsed: DataFrame, sense_messages: DataFrame, pill_raw: DataFrame, width_ms: int
) -> DataFrame:
    """Every meter of both streams per bucket."""
    return (
        sense_meters(sense_parsed, width_ms)
        .unionByName(low_uptime_meter(low_uptime_first(sense_messages), width_ms))
        .unionByName(pill_meters(pill_raw, width_ms))
    )


def meter_rates(minute_events: DataFrame) -> DataFrame:
    """Events per second over aligned windows of 1, 5 and 15 minutes.

    ``minute_events`` are one-minute meter counts: the wider windows roll up the minutes and never
    touch the messages again.
    """
    minutes = F.explode(F.array(*[F.lit(m) for m in RATE_WINDOWS])).alias("window_minutes")
    start = F.col("window_start") - F.pmod(
        F.col("window_start"), F.col("window_minutes").cast("long") * clock.MINUTE_MS
    )
    return (
        minute_events.select("metric", "window_start", "events", minutes)
        .groupBy("metric", "window_minutes", start.alias("window_start"))
        .agg(F.sum("events").alias("events"))
        .withColumn("rate", F.round(F.col("events") / (F.col("window_minutes") * 60), 6))
    )


# -- report ------------------------------------------------------------------------------------

UPTIME_HISTOGRAM = "sense.uptime-days"


def included(names: Iterable[str], include: Iterable[str] | None) -> list[str]:
    """Names in which any include pattern is found; no list includes all."""
    names = list(names)
    if include is None:
        return names
    patterns = [re.compile(p) for p in include]
    return [n for n in names if any(p.search(n) for p in patterns)]


REPORTED = (*(f"sense.{n}" for n in SENSE_METERS), "sense.low-uptime", UPTIME_HISTOGRAM, "pill.messages-processed")


def check_interval(interval_seconds: int) -> None:
    shortest, longest = REPORT_INTERVAL_SECONDS
    if not shortest <= interval_seconds <= longest:
        raise ValueError(f"reporting interval must be {shortest} to {longest} seconds")


def reported(events: DataFrame, histogram: DataFrame | None, interval_seconds: int) -> DataFrame:
    """(metric, window_start, value) from meter counts (metric, window_start, events) and the uptimes (window_start, days, n)."""
    pairs = F.array(
        F.struct(F.concat("metric", F.lit(".count")).alias("metric"), F.col("events").cast("double").alias("value")),
        F.struct(
            F.concat("metric", F.lit(".rate")).alias("metric"), F.round(F.col("events") / interval_seconds, 6).alias("value")
        ),
    )
    report = events.select("window_start", F.inline(pairs)).select("metric", "window_start", "value")
    if histogram is None:
        return report
    columns = {"min": "min_days", "max": "max_days", "mean": "mean_days", **{p: p for p in QUANTILES}}
    wide = distribution(histogram, "window_start").select(
        "window_start", *[F.col(c).cast("double").alias(f"{UPTIME_HISTOGRAM}.{n}") for n, c in columns.items()]
    )
    names = [f"{UPTIME_HISTOGRAM}.{n}" for n in columns]
    return report.unionByName(unpivot(wide, ["window_start"], names, "metric", "value").select("metric", "window_start", "value"))


def metrics_report(
    sense_parsed: DataFrame,
    sense_messages: DataFrame,
    pill_raw: DataFrame,
    include: Iterable[str] | None = None,
    interval_seconds: int = 30,
) -> DataFrame:
    """(metric, window_start, value) per reporting interval, for the included metrics only.

    A meter reports its events in the interval and their rate per second; the histogram reports
    its statistics. The include list is applied to the metric names before the plan is built, so
    an excluded metric is not computed.
    """
    check_interval(interval_seconds)
    width = interval_seconds * 1000
    chosen = included(REPORTED, include)
    parts = []
    counted = [n for n in _named(chosen, "sense.") if n in SENSE_METERS]
    if counted:
        parts.append(sense_meters(sense_parsed, width, counted))
    if "sense.low-uptime" in chosen:
        parts.append(low_uptime_meter(low_uptime_first(sense_messages), width))
    if "pill.messages-processed" in chosen:
        parts.append(pill_meters(pill_raw, width))
    histogram = None
    if UPTIME_HISTOGRAM in chosen:
        bucket = clock.floor_ms(F.col("arrival_ms"), width).alias("window_start")
        histogram = uptime_histogram(sense_messages.withColumn("window_start", bucket), "window_start")
    none = sense_parsed.sparkSession.createDataFrame([], "metric string, window_start long, events long")
    events = reduce(DataFrame.unionByName, parts) if parts else none
    return reported(events, histogram, interval_seconds)
