"""Every named query: a callable of (spark, directory of the input tables) that returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter import schemas
from fleetmeter.functions.clock import MINUTE_MS
from fleetmeter.operators import devices, export, firmware, metrics, periods, positions, quality
from fleetmeter.plans.streams import PILL_STREAM, REPORT_INCLUDE, SENSE_STREAM, STREAMS
from fleetmeter.sources import decode, derived
from fleetmeter.sources.tables import decode_once

Query = Callable[[SparkSession, str], DataFrame]

def _sense_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.parse(derived.sense_raw(spark, sf_dir), schemas.SENSE_MESSAGE)


def _pill_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.parse(derived.pill_raw(spark, sf_dir), schemas.PILL_MESSAGE)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.sense_messages(_sense_parsed(spark, sf_dir))


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.pill_readings(decode.pill_messages(_pill_parsed(spark, sf_dir)))


def _firmware(spark: SparkSession, sf_dir: str) -> DataFrame:
    return firmware.sense_firmware(_messages(spark, sf_dir))


def _sense(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_messages(spark, sf_dir))


def _pill(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_readings(spark, sf_dir))


def _versions(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_firmware(spark, sf_dir))


def _live(hourly: Query) -> Query:
    """Live sets as of the newest event; a one-column scan gives the clock."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        now = derived.events(spark, sf_dir).agg(F.call_function("div", F.max("ms"), F.lit(1000)).alias("now"))
        return devices.live(hourly(spark, sf_dir), now.scalar())

    return query


def _low_uptime_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = derived.sense_raw(spark, sf_dir).select("shard_id", "arrival_ms")
    return periods.low_uptime_devices_chained(arrivals, _messages(spark, sf_dir))


def _meter_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = decode_once(_sense_parsed(spark, sf_dir), "meter_rates")
    minutes = metrics.meter_events(
        parsed, decode.sense_messages(parsed), derived.pill_raw(spark, sf_dir), MINUTE_MS
    )
    return metrics.meter_rates(minutes)


def _metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = decode_once(_sense_parsed(spark, sf_dir), "metrics_report")
    return metrics.metrics_report(
        parsed, decode.sense_messages(parsed), derived.pill_raw(spark, sf_dir), REPORT_INCLUDE
    )


def _state_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = decode.sense_messages(decode_once(_sense_parsed(spark, sf_dir), "export_sense"))
    readings = decode.pill_readings(decode.pill_messages(decode_once(_pill_parsed(spark, sf_dir), "export_pill")))
    sense = export.sense_export(
        devices.sense_state(messages), firmware.version_state(firmware.sense_firmware(messages))
    )
    return (
        sense.unionByName(export.entries(devices.active_pills(readings), "active_pills", "device_id", F.col("seen_at")))
        .unionByName(export.hourly_set(devices.hourly_active_sense(messages), "hourly_active_sense_"))
        .unionByName(export.hourly_set(devices.hourly_active_pill(readings), "hourly_active_pill_"))
    )


def _sense_positions(messages: DataFrame) -> DataFrame:
    return positions.checkpoint_track(positions.kept_positions(positions.sense_times(messages)), SENSE_STREAM)


def _pill_positions(readings: DataFrame) -> DataFrame:
    return positions.checkpoint_track(positions.kept_positions(positions.pill_times(readings)), PILL_STREAM)


QUERIES: dict[str, Query] = {
    # decode
    "sense_dead_letters": lambda spark, sf_dir: decode.dead_letters(_sense_parsed(spark, sf_dir)),
    "pill_dead_letters": lambda spark, sf_dir: decode.dead_letters(_pill_parsed(spark, sf_dir)),
    # devices
    "active_senses": _sense(devices.active_senses),
    "active_pills": _pill(devices.active_pills),
    "sense_uptimes": _sense(devices.sense_uptimes),
    "wifi_info": _sense(devices.wifi_info),
    "hourly_active_sense": _sense(devices.hourly_active_sense),
    "hourly_active_pill": _pill(devices.hourly_active_pill),
    "hourly_active_sense_live": _live(_sense(devices.hourly_active_sense)),
    "hourly_active_pill_live": _live(_pill(devices.hourly_active_pill)),
    # firmware
    "sense_firmware": _sense(firmware.sense_firmware),
    "missing_top_firmware": _sense(firmware.missing_top_firmware),
    "device_firmware": _versions(firmware.device_firmware),
    "firmwares_seen": _versions(firmware.firmwares_seen),
    "top_firmwares_seen": _versions(firmware.top_firmwares_seen),
    "middle_firmware_devices": _versions(firmware.middle_firmware_devices),
    "top_firmware_devices": _versions(firmware.top_firmware_devices),
    # data quality
    "data_quality_counts": _sense(quality.data_quality_counts),
    "bad_sensor_events": _sense(quality.bad_sensor_events),
    # metrics
    "sense_messages_processed": lambda spark, sf_dir: metrics.messages_processed(derived.sense_raw(spark, sf_dir)),
    "pill_messages_processed": lambda spark, sf_dir: metrics.messages_processed(derived.pill_raw(spark, sf_dir)),
    "wave_counts": _sense(metrics.wave_counts),
    "low_uptime_devices": _sense(metrics.low_uptime_devices),
    "low_uptime_devices_approx": _sense(metrics.low_uptime_devices_approx),
    "low_uptime_devices_chained": _low_uptime_chained,
    "uptime_days": _sense(metrics.uptime_days),
    "meter_rates": _meter_rates,
    "metrics_report": _metrics_report,
    # position index
    "sense_checkpoint_track": _sense(_sense_positions),
    "pill_checkpoint_track": _pill(_pill_positions),
    # all keyed tables under their store names
    "state_export": _state_export,
    # the same results from streams
    **{f"{name}_stream": query for name, query in STREAMS.items()},
}
