"""Named queries that run as streams: the raw records go to the shared folder, are read back in a
few bounded batches and come out of the stored tables. The batches split the records at random, so
late and out-of-order records are the rule, not the exception.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetmeter import schemas
from fleetmeter.functions import rules
from fleetmeter.operators import devices, firmware, metrics, positions
from fleetmeter.sources import decode, derived, shards
from fleetmeter.sources.raw import read_stream
from fleetmeter.sources.tables import scratch_dir, stored
from fleetmeter.streaming import changes, fields, jobs, report
from fleetmeter.streaming.state import with_rocksdb

SENSE_STREAM = "sense_sensors_data"
PILL_STREAM = "batch_pill_data"

BATCHES = 4
# Fetches of a shard that one batch of a log takes, each a task.
FETCHES = 64
NOW = {"availableNow": True}
NEXT = {"processingTime": "0 seconds"}

# The include list of the registered report.
REPORT_INCLUDE = ("messages-processed", "wave", "^sense\\.low-", "uptime-days")


def _stage(raw: DataFrame, path: str) -> DataFrame:
    """Write the records as one file per shuffle partition and read them as ``BATCHES`` batches."""
    spark = raw.sparkSession
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw.repartition(files, "shard_id", "sequence_number").write.parquet(path)
    return read_stream(spark, path, max_files=math.ceil(files / BATCHES))


def _job(start: Callable, make_raw: Callable, table: str, view: Callable[[DataFrame], DataFrame]) -> Callable:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        place = scratch_dir(spark, table)
        stream = _stage(make_raw(spark, sf_dir), f"{place}/raw")
        start(stream, f"{place}/out", f"{place}/offsets", [table], NOW).awaitTermination()
        return view(jobs.read_table(spark, f"{place}/out", table))

    return query


def _active_senses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stateful aggregation in update mode; each batch appends the devices it changed."""
    place = scratch_dir(spark, "active_senses")
    messages = decode.decode_sense(_stage(derived.sense_raw(spark, sf_dir), f"{place}/raw"))
    out = f"{place}/out"
    (
        devices.sense_state(with_rocksdb(messages))
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: changes.write(batch, out, batch_id))
        .option("checkpointLocation", f"{place}/offsets")
        .trigger(**NOW)
        .start()
        .awaitTermination()
    )
    return changes.read(spark, out, jobs.SENSE_TABLES["sense_state"].reduce).select("device_id", "received_at")


def _device_firmware(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial updates as native state."""
    place = scratch_dir(spark, "device_firmware")
    stream = decode.decode_sense(_stage(derived.sense_raw(spark, sf_dir), f"{place}/raw"))
    out = f"{place}/out"
    fields.start_firmware(firmware.sense_firmware(stream), out, f"{place}/offsets", NOW).awaitTermination()
    return changes.read(spark, out, fields.device_firmware)


def _meter_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all meters from the minute tables of both streams."""
    place = scratch_dir(spark, "meter_rates")
    sense = _stage(derived.sense_raw(spark, sf_dir), f"{place}/sense")
    pill = _stage(derived.pill_raw(spark, sf_dir), f"{place}/pill")
    running = [
        jobs.start_sense(sense, f"{place}/out", f"{place}/sense_offsets", ["sense_minutes", "low_uptime"], NOW),
        jobs.start_pill(pill, f"{place}/out", f"{place}/pill_offsets", ["pill_minutes"], NOW),
    ]
    for query in running:
        query.awaitTermination()
    return metrics.meter_rates(jobs.minute_events(spark, f"{place}/out"))


def _segments(raw: DataFrame) -> tuple[list[DataFrame], int]:
    """The records in ``BATCHES`` parts by arrival, one in five a part late, and how late a record can be, in seconds."""
    raw = stored(raw, "records")
    span = raw.agg(F.min("arrival_ms").alias("first"), F.max("arrival_ms").alias("last")).first()
    first, last = span["first"] or 0, span["last"] or 0
    step = (last - first) // BATCHES + 1
    late = (F.pmod(F.xxhash64("sequence_number"), F.lit(5)) == 0).cast("int")
    part = F.least(F.expr(f"(arrival_ms - {first}) div {step}") + late, F.lit(BATCHES - 1))
    # Two heartbeats: the first moves the clock past all intervals, in the second's batch they close.
    beats = [raw.sparkSession.createDataFrame([(None, None, last + (10 + i) * step, None)], schemas.RAW) for i in range(2)]
    return [raw.where(part == i) for i in range(BATCHES)] + beats, 2 * step // 1000 + 1


Start = Callable[[DataFrame], StreamingQuery]


def _through_logs(spark: SparkSession, logs: list[tuple[list[DataFrame], str, str, Start]]) -> None:
    """Run a query on each shard log (its parts, path, checkpoint), while the logs grow part by part, until all is read."""
    running, most = [], shards.MAX_RECORDS_PER_FETCH
    try:
        for i in range(max(len(parts) for parts, *_ in logs)):
            for parts, path, offsets, start in logs:
                shards.append(parts[i], path, i)
                if not i:
                    running.append(start(shards.read_stream(spark, path, offsets, records=most, fetches=FETCHES)))
            for query in running:
                query.processAllAvailable()
    finally:
        for query in running:
            query.stop()


def _metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of both streams, read from shard logs and closed interval by interval."""
    place = scratch_dir(spark, "metrics_report")
    logs = []
    for name, make, start in (("sense", derived.sense_raw, report.start_sense), ("pill", derived.pill_raw, report.start_pill)):
        parts, late = _segments(make(spark, sf_dir))
        out, offsets = f"{place}/{name}_report", f"{place}/{name}_offsets"
        run = partial(start, path=out, checkpoint=offsets, include=REPORT_INCLUDE, grace=f"{late} seconds", trigger=NEXT)
        logs.append((parts, f"{place}/{name}", offsets, run))
    _through_logs(spark, logs)
    return report.read(spark, [f"{place}/sense_report", f"{place}/pill_report"])


def _sense_firmware(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a shard log to an appended table."""
    place = scratch_dir(spark, "sense_firmware")
    offsets, out = f"{place}/offsets", f"{place}/out"

    def start(log: DataFrame) -> StreamingQuery:
        rows = firmware.sense_firmware(decode.decode_sense(log))
        return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", offsets).trigger(**NEXT).start()

    _through_logs(spark, [(_segments(derived.sense_raw(spark, sf_dir))[0], f"{place}/log", offsets, start)])
    return spark.read.parquet(out)


def _low_uptime_counts(first: DataFrame) -> DataFrame:
    return first.groupBy("shard_id", "hour_start").agg(F.count(F.lit(1)).alias("devices"))


def _live(start: Callable, make_raw: Callable, table: str) -> Callable:
    """The live hourly sets as of the newest event, from the rings."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        now = derived.events(spark, sf_dir).agg(F.max("ms")).first()[0]
        return _job(start, make_raw, table, lambda rings: devices.with_hour_key(devices.ring_hours(rings, now or 0)))(spark, sf_dir)

    return query


def _sum(metric: str, name: str) -> Callable[[DataFrame], DataFrame]:
    def total(minutes: DataFrame) -> DataFrame:
        return minutes.where(F.col("metric") == metric).agg(F.coalesce(F.sum("events"), F.lit(0).cast("long")).alias(name))

    return total


def _quality_counts(minutes: DataFrame) -> DataFrame:
    meters = F.explode(F.array(*[F.lit(m) for m in rules.METERS])).alias("meter")
    names = minutes.sparkSession.range(1).select(meters)
    counts = minutes.groupBy(F.col("metric").substr(F.lit(len("sense.") + 1), F.length("metric")).alias("meter")).agg(
        F.sum("events").alias("events")
    )
    return names.join(counts, "meter", "left").select("meter", F.coalesce("events", F.lit(0).cast("long")).alias("events"))


def _sense(table: str, view: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Callable:
    return _job(jobs.start_sense, derived.sense_raw, table, view)


def _pill(table: str, view: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Callable:
    return _job(jobs.start_pill, derived.pill_raw, table, view)


# Name of the batch query with the same result -> streaming query.
STREAMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sense_dead_letters": _sense("sense_dead_letters"),
    "pill_dead_letters": _pill("pill_dead_letters"),
    "active_senses": _active_senses,
    "active_pills": _pill("pill_state", lambda t: t.select("device_id", "seen_at")),
    "sense_uptimes": _sense("sense_state", lambda t: t.select("device_id", "uptime_seconds")),
    "wifi_info": _sense("sense_state", devices.with_wifi_text),
    "device_firmware": _device_firmware,
    "firmwares_seen": _sense("firmware_versions", lambda t: firmware.seen_view(t, "middle")),
    "top_firmwares_seen": _sense("firmware_versions", lambda t: firmware.seen_view(t, "top")),
    "middle_firmware_devices": _sense("firmware_versions", lambda t: firmware.devices_view(t, "middle")),
    "top_firmware_devices": _sense("firmware_versions", lambda t: firmware.devices_view(t, "top")),
    "hourly_active_sense": _sense("sense_hours", devices.with_hour_key),
    "hourly_active_pill": _pill("pill_hours", devices.with_hour_key),
    "hourly_active_sense_live": _live(jobs.start_sense, derived.sense_raw, "sense_rings"),
    "hourly_active_pill_live": _live(jobs.start_pill, derived.pill_raw, "pill_rings"),
    "low_uptime_devices": _sense("low_uptime", _low_uptime_counts),
    "low_uptime_devices_approx": _sense("low_uptime_sketches", metrics.sketched_devices),
    "uptime_days": _sense("uptime_histogram", metrics.distribution),
    "meter_rates": _meter_rates,
    "data_quality_counts": _sense("sense_minutes", _quality_counts),
    "wave_counts": _sense("sense_minutes", _sum("sense.wave-counts", "wave_count")),
    "sense_messages_processed": _sense("sense_minutes", _sum("sense.messages-processed", "messages")),
    "pill_messages_processed": _pill("pill_minutes", _sum("pill.messages-processed", "messages")),
    "bad_sensor_events": _sense("bad_sensor_events"),
    "metrics_report": _metrics_report,
    "sense_firmware": _sense_firmware,
    "sense_checkpoint_track": _sense(jobs.SENSE_POSITIONS, lambda t: positions.checkpoint_track(t, SENSE_STREAM)),
    "pill_checkpoint_track": _pill(jobs.PILL_POSITIONS, lambda t: positions.checkpoint_track(t, PILL_STREAM)),
}
