"""Stateful processors: the report that closes its intervals once, and partial updates of devices."""

import json

import pytest
from conftest import SF_DIR
from helpers import message, point, rows
from pyspark.sql import functions as F

from fleetmeter import schemas
from fleetmeter.operators import firmware, metrics
from fleetmeter.sources import decode, derived
from fleetmeter.sources.raw import read_batch, read_stream
from fleetmeter.streaming import changes, fields, report

NOW = {"availableNow": True}
T = 1_700_000_010_000  # start of an interval


def write(spark, path, *batches):
    """One file, and so one batch, for each list of (sequence, arrival, payload); no payload is a heartbeat."""
    for batch in batches:
        data = [
            (None if payload is None else "s0", str(n), at, payload if payload is None or isinstance(payload, str) else json.dumps(payload))
            for n, at, payload in batch
        ]
        spark.createDataFrame(data, schemas.RAW).coalesce(1).write.mode("append").parquet(path)


def closed(spark, source, out, checkpoint, grace="30 seconds", include=None):
    report.start_sense(read_stream(spark, source, max_files=1), out, checkpoint, include, 30, grace, NOW).awaitTermination()
    return spark.read.parquet(out).select("window_start", "name", "events")


def test_late_records_within_the_grace_count_in_their_interval(spark, tmp_path):
    low, high = {"uptime_in_second": 60}, {"uptime_in_second": 90_000}
    batches = [
        [(1, T + 40_000, message("a", points=[point(co2=1), point(wave_count=2)], **low)), (2, T + 1_000, message("b", **high))],
        [(3, T + 20_000, message("a", **low)), (4, T + 2_000, "{bad")],  # late, and the device's first low uptime
        [(5, T + 41_000, message("a", **low)), (6, T + 95_000, message("c", **high))],
        [(7, T + 600_000, None)],
        [(8, T + 700_000, None)],
    ]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, source, *batches)
    found = closed(spark, source, out, str(tmp_path / "cp"))
    per_name = found.groupBy("window_start", "name").agg(F.sum("events").alias("events")).where("NOT startswith(name, 'days:')")
    want = {
        (T, "sense.messages-processed"): 3, (T, "sense.low-uptime"): 1,
        (T + 30_000, "sense.messages-processed"): 2, (T + 30_000, "sense.low-co2"): 1, (T + 30_000, "sense.wave-counts"): 2,
        (T + 90_000, "sense.messages-processed"): 1,
    }
    assert {(r.window_start, r.name): r.events for r in per_name.collect()} == want
    parsed = decode.parse(read_batch(spark, source).where("shard_id IS NOT NULL"), schemas.SENSE_MESSAGE)
    batch = metrics.metrics_report(parsed, decode.sense_messages(parsed), parsed.limit(0))
    assert rows(report.read(spark, [out])) == rows(batch)


def test_records_later_than_that_count_once_in_an_open_interval(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [[(10 * b + i, T + 60_000 * b - (i % 4) * 45_000, message(f"d{i}")) for i in range(10)] for b in range(6)]
    write(spark, source, *batches, [(98, T + 10**7, None)], [(99, T + 2 * 10**7, None)])
    found = closed(spark, source, out, str(tmp_path / "cp"), "1 second", ["messages"])
    assert found.agg(F.sum("events")).first()[0] == 60
    read = report.read(spark, [out]).where("endswith(metric, '.count')")
    assert read.count() == read.select("window_start").distinct().count()
    emitted = changes.read(spark, out, lambda t: t).count()
    assert emitted == found.count()  # no interval of a processor went out twice
    exact = {T + 60_000 * b - (i % 4) * 45_000 for b in range(6) for i in range(10)}
    assert {r.window_start for r in found.collect()} <= {t - t % 30_000 for t in exact} | {t - t % 30_000 for t in range(T, T + 400_000, 30_000)}


def test_a_repeated_batch_reports_nothing_twice(spark, tmp_path, monkeypatch):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    write(spark, source, *[[(i, T + 60_000 * i, message("a"))] for i in range(5)], [(98, T + 10**7, None)], [(99, T + 2 * 10**7, None)])
    original, calls = changes.write, []

    def flaky(batch, path, batch_id):
        original(batch, path, batch_id)
        if batch_id == 4 and not calls:
            calls.append(batch_id)
            raise OSError("lost")

    monkeypatch.setattr(changes, "write", flaky)
    with pytest.raises(Exception, match="lost"):
        closed(spark, source, out, checkpoint)
    found = closed(spark, source, out, checkpoint, include=None).where("name = 'sense.messages-processed'")
    assert calls and rows(found, "window_start", "events") == [(T + 60_000 * i, 1) for i in range(5)]


def test_partial_updates_equal_batch_and_write_only_changes(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    raw = derived.sense_raw(spark, SF_DIR).cache()
    for i in (2, 0, 1):  # out of order
        raw.where(F.pmod(F.xxhash64("sequence_number"), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(source)
    raw.limit(40).coalesce(1).write.mode("append").parquet(source)  # repeated records
    stream = firmware.sense_firmware(decode.decode_sense(read_stream(spark, source, max_files=1)))
    fields.start_firmware(stream, out, str(tmp_path / "cp"), NOW).awaitTermination()
    batch = firmware.device_firmware(firmware.sense_firmware(decode.decode_sense(raw)))
    assert rows(changes.read(spark, out, fields.device_firmware), *batch.columns) == rows(batch)
    written = spark.read.parquet(out)
    assert written.where("folder = 'b000000000003'").count() == 0
    assert written.groupBy("device_id", "field", "folder").count().where("count > 1").count() == 0


def test_fields_keep_what_arrived_last_in_plain_aggregated_state(spark, tmp_path):
    """A late record changes nothing, an equal arrival neither; no Python runs for each device of a batch."""
    schema = "device_id string, field string, digits int, number string, shard string, value string"
    batches = [
        [("a", "top", 2, "20", "s0", "x"), ("a", "top", 1, "3", "s0", "older"), ("b", "top", 1, "5", "s0", "y")],
        [("a", "top", 2, "11", "s0", "late"), ("a", "middle", 1, "1", "s0", "m"), ("b", "top", 1, "5", "s0", "z")],
        [("a", "top", 2, "20", "s1", "next"), ("b", "top", 1, "4", "s9", "late")],
    ]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
    stream = fields.changed(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source))
    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: changes.write(batch, out, batch_id))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(**NOW)
        .start()
    )
    query.awaitTermination()
    operators = [o.operatorName for p in query.recentProgress for o in p.stateOperators]
    assert operators and set(operators) == {"stateStoreSave"}
    written = spark.read.parquet(out).selectExpr("right(folder, 1) AS batch", "device_id", "field", "value")
    want = [("0", "a", "top", "x"), ("0", "b", "top", "y"), ("1", "a", "middle", "m"), ("2", "a", "top", "next")]
    assert rows(written) == want
