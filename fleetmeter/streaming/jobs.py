"""Sense and pill streams to all result tables.

Each stream batch is decoded once and kept for the batch; every table then reduces it to its
changed keys and writes those (``changes``). Writes come before the offset commit and repeat
safely, so a failed batch is retried without loss or double counting. Late and out-of-order
records are never dropped: state is ordered by arrival, whichever batch a record came in.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import NamedTuple

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetmeter import schemas
from fleetmeter.functions.clock import HOUR_MS, MINUTE_MS, hour_expiry
from fleetmeter.operators import devices, firmware, metrics, positions, quality
from fleetmeter.operators.latest import reduce_latest
from fleetmeter.sources import decode, tables
from fleetmeter.sources.raw import READ_INTERVAL
from fleetmeter.streaming import changes

# Tables of a batch that are written at the same time.
PARALLEL_WRITES = 4

# Old folders of a reducible table are folded once in this many batches.
FOLD_EVERY = 100


class Table(NamedTuple):
    """``rows`` makes the batch's rows from its parsed records; ``reduce`` merges folders (none: they are appended).

    ``view`` makes what readers get of the merged rows. ``purge`` is a merge as of an hour, for tables whose rows expire.
    """

    rows: Callable[[DataFrame], DataFrame]
    reduce: changes.Reduce = lambda rows: rows
    view: changes.Reduce = lambda rows: rows
    purge: Callable[[DataFrame, int], DataFrame] | None = None


def _from_messages(operator: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    return lambda parsed: operator(decode.sense_messages(parsed))


def _from_readings(operator: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    return lambda parsed: operator(decode.pill_readings(decode.pill_messages(parsed)))


def _sum_events(rows: DataFrame) -> DataFrame:
    return rows.groupBy("metric", "window_start").agg(F.sum("events").alias("events"))


def _live_hours(hours: DataFrame, hour: int) -> DataFrame:
    """Members of hourly sets that still live at the start of ``hour``."""
    return hours.distinct().where(hour_expiry(F.col("hour_start")) > hour * HOUR_MS // 1000)


def _sum_days(rows: DataFrame) -> DataFrame:
    return rows.groupBy("days").agg(F.sum("n").alias("n"))


def _distinct(rows: DataFrame) -> DataFrame:
    return rows.distinct()


# The position index of each stream, kept as a staircase for each shard and thinned on read.
SENSE_POSITIONS = "sense_positions"
PILL_POSITIONS = "pill_positions"

SENSE_TABLES: dict[str, Table] = {
    "sense_dead_letters": Table(decode.dead_letters),
    "sense_state": Table(
        _from_messages(devices.sense_state),
        partial(reduce_latest, keys=["device_id"], values=devices.SENSE_STATE),
    ),
    "firmware_versions": Table(
        _from_messages(lambda m: firmware.version_state(firmware.sense_firmware(m))), firmware.reduce_version_state
    ),
    "sense_hours": Table(_from_messages(lambda m: devices.active_hours(m, "arrival_ms")), _distinct, purge=_live_hours),
    "sense_rings": Table(
        _from_messages(lambda m: devices.hour_rings(m, "arrival_ms")), devices.merge_rings, purge=devices.turn_rings
    ),
    "low_uptime": Table(_from_messages(metrics.low_uptime_first), metrics.reduce_low_uptime),
    "low_uptime_sketches": Table(_from_messages(metrics.low_uptime_sketches), metrics.merge_sketches),
    "uptime_histogram": Table(_from_messages(metrics.uptime_histogram), _sum_days),
    "bad_sensor_events": Table(_from_messages(quality.bad_sensor_events)),
    "sense_minutes": Table(lambda parsed: metrics.sense_meters(parsed, MINUTE_MS), _sum_events),
    SENSE_POSITIONS: Table(
        _from_messages(lambda m: positions.candidates(positions.sense_times(m))),
        positions.reduce_candidates,
        positions.thinned,
    ),
}

PILL_TABLES: dict[str, Table] = {
    "pill_dead_letters": Table(decode.dead_letters),
    "pill_state": Table(
        _from_readings(devices.pill_state), partial(reduce_latest, keys=["device_id"], values=["seen_at"])
    ),
    "pill_hours": Table(_from_readings(lambda r: devices.active_hours(r, "arrival_ms")), _distinct, purge=_live_hours),
    "pill_rings": Table(
        _from_readings(lambda r: devices.hour_rings(r, "arrival_ms")), devices.merge_rings, purge=devices.turn_rings
    ),
    "pill_minutes": Table(lambda parsed: metrics.pill_meters(parsed, MINUTE_MS), _sum_events),
    PILL_POSITIONS: Table(
        _from_readings(lambda r: positions.candidates(positions.pill_times(r))),
        positions.reduce_candidates,
        positions.thinned,
    ),
}

# One row per (hour, device). The rings hold the live ones in a row per device; ask for these only to keep more hours than that.
HOUR_TABLES = ("sense_hours", "pill_hours")


def _merge_of(table: Table, parsed: DataFrame) -> changes.Reduce:
    """The merge of a fold; where rows expire, without those that had expired when the batch arrived.

    A record whose arrival lies ahead of the clock of this job moves nothing beyond that clock.
    """
    arrived = parsed.agg(F.max("arrival_ms")).first()[0] if table.purge else None
    if arrived is None:
        return table.reduce
    hour = min(arrived, int(time.time() * 1000)) // HOUR_MS
    return lambda rows: table.purge(rows, hour)


def _start(
    raw: DataFrame,
    out: str,
    checkpoint: str,
    message,
    chosen: dict[str, Table],
    trigger: dict | None,
    fold_every: int,
) -> StreamingQuery:
    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folds = batch_id > 0 and batch_id % fold_every == 0
        # Only a dead letter needs its payload after the parse.
        parsed = decode.parse(batch, message).withColumn("payload", F.when(F.col("malformed"), F.col("payload")))

        def write_table(name: str) -> None:
            table, path = chosen[name], f"{out}/{name}"
            changes.write(table.rows(parsed), path, batch_id)
            if folds:
                changes.fold(spark, path, batch_id - 1, _merge_of(table, parsed))

        writes = [partial(write_table, name) for name in chosen]
        if len(writes) > 1:
            parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # The first write fills the cache; the others then share the cluster.
            writes[0]()
            with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
                for done in [pool.submit(inheritable_thread_target(spark)(write)) for write in writes[1:]]:
                    done.result()
        finally:
            parsed.unpersist()

    return (
        raw.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": READ_INTERVAL}))
        .start()
    )


def _chosen(known: dict[str, Table], names: Iterable[str] | None) -> dict[str, Table]:
    names = set(known) - set(HOUR_TABLES) if names is None else set(names)
    return {n: t for n, t in known.items() if n in names}


def start_sense(
    raw: DataFrame,
    out: str,
    checkpoint: str,
    only: Iterable[str] | None = None,
    trigger: dict | None = None,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Feed the sense tables below ``out``; ``only`` names a subset of them."""
    return _start(raw, out, checkpoint, schemas.SENSE_MESSAGE, _chosen(SENSE_TABLES, only), trigger, fold_every)


def start_pill(
    raw: DataFrame,
    out: str,
    checkpoint: str,
    only: Iterable[str] | None = None,
    trigger: dict | None = None,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    return _start(raw, out, checkpoint, schemas.PILL_MESSAGE, _chosen(PILL_TABLES, only), trigger, fold_every)


def read_table(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Current content of a table fed by either job."""
    table = {**SENSE_TABLES, **PILL_TABLES}[name]
    return table.view(changes.read(spark, f"{out}/{name}", table.reduce))


def live_hours(spark: SparkSession, out: str, name: str, as_of_ms: int) -> DataFrame:
    """(hour_start, device_id) of the hourly sets that live at ``as_of_ms``, from ``sense_rings`` or ``pill_rings``."""
    return devices.ring_hours(read_table(spark, out, name), as_of_ms)


def publish_positions(spark: SparkSession, out: str, name: str, stream: str, table: str) -> None:
    """Write the position index of a stream to ``table``, which is created when it is missing.

    A late record can move what is kept before it, so the stream's rows are replaced as a whole; they are sampled, a row for five minutes.
    """
    tables.create_checkpoint_table(spark, table)
    track = positions.checkpoint_track(read_table(spark, out, name), stream)
    others = spark.table(table).where(~F.col("stream_shard_id").startswith(f"{stream}:"))
    kept = tables.stored(others.unionByName(track), "positions")
    kept.write.insertInto(table, overwrite=True)


def minute_events(spark: SparkSession, out: str) -> DataFrame:
    """Events of every meter per minute, for ``metrics.meter_rates``; both jobs share ``out``."""
    low_uptime = metrics.low_uptime_meter(read_table(spark, out, "low_uptime"), MINUTE_MS)
    return (
        read_table(spark, out, "sense_minutes")
        .unionByName(low_uptime)
        .unionByName(read_table(spark, out, "pill_minutes"))
    )
