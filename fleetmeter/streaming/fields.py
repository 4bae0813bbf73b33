"""Partial updates as native state: one value per field of a device, and only fields that change are written.

A message may set any of a device's fields and leave the others alone. A streaming aggregation keeps, in RocksDB, of every
field of a device the value that arrived last and the batch that brought it; a record that arrives late or again changes
nothing that is newer. Each task reduces its records to one update a field first, so a busy device is thinned where it is read.
There is no watermark, so nothing is dropped, and the output of a batch is what it changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetmeter.functions.arrival import arrival
from fleetmeter.operators.firmware import UNKNOWN
from fleetmeter.operators.latest import reduce_latest
from fleetmeter.streaming import changes
from fleetmeter.streaming.state import with_rocksdb

FIRMWARE_FIELDS = ("middle_version", "top_version", "timestamp")


def firmware_updates(firmware: DataFrame) -> DataFrame:
    """The fields that each message sets, as text: known versions, and the time at which either was set."""
    middle, top = F.col("middle_version") != UNKNOWN, F.col("top_version") != UNKNOWN
    known = {"middle_version": middle, "top_version": top, "timestamp": middle | top}
    fields = [
        F.when(k, F.struct(F.lit(f).alias("field"), arrival().alias("arrival"), F.col(f).cast("string").alias("value")))
        for f, k in known.items()
    ]
    rows = firmware.select("device_id", F.inline(F.array_compact(F.array(*fields))))
    return rows.select("device_id", "field", "arrival.*", "value")


def changed(updates: DataFrame) -> DataFrame:
    """The updates of a stream that change a field. Of equal arrivals the earliest batch's stays, so a repeat changes nothing."""
    # The time of the batch: the same in all of its rows, and when it is run again.
    age = -F.unix_millis(F.current_timestamp())
    update = F.struct("digits", "number", "shard", "age", "value")
    last = with_rocksdb(updates).withColumn("age", age).groupBy("device_id", "field").agg(F.max(update).alias("last"))
    fresh = last.where(F.col("last.age") == age)
    return fresh.select("device_id", "field", "last.digits", "last.number", "last.shard", "last.value")


def start_firmware(firmware: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write the changed firmware fields of a stream below ``path``."""
    return (
        changed(firmware_updates(firmware))
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: changes.write(batch, path, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def merge_updates(updates: DataFrame) -> DataFrame:
    """The last update of each field; associative and idempotent."""
    rows = updates.select("device_id", "field", F.struct("digits", "number", "shard").alias("arrival"), "value")
    return reduce_latest(rows, ["device_id", "field"], ["value"]).select("device_id", "field", "arrival.*", "value")


def device_firmware(updates: DataFrame) -> DataFrame:
    """One row per device, a field that was never set as null."""
    wide = merge_updates(updates).groupBy("device_id").pivot("field", list(FIRMWARE_FIELDS)).agg(F.first("value"))
    return wide.withColumn("timestamp", F.col("timestamp").cast("long"))
