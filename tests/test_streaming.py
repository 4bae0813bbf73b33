"""Stream results against batch results over the same records, across restarts and repeats."""

import pytest
from conftest import SF_DIR
from helpers import message, raw, rows
from pyspark.sql import functions as F

from fleetmeter import schemas
from fleetmeter.functions.arrival import arrival
from fleetmeter.functions.clock import HOUR_MS, MINUTE_MS
from fleetmeter.operators import devices, firmware, metrics, positions, quality
from fleetmeter.sources import decode, derived
from fleetmeter.sources.raw import read_batch, read_stream
from fleetmeter.sources.tables import create_checkpoint_table, read_decoded, scratch_dir, write_decoded
from fleetmeter.streaming import changes, jobs

NOW = {"availableNow": True}
SLICES = 4


@pytest.fixture(scope="module")
def streams(spark, tmp_path_factory):
    """Raw tables of both streams, written file after file in arrival order."""
    paths = {}
    for name, make in (("sense", derived.sense_raw), ("pill", derived.pill_raw)):
        path = str(tmp_path_factory.mktemp(name))
        records = make(spark, SF_DIR).withColumn("slice", F.ntile(SLICES).over(_by_arrival())).cache()
        for i in range(1, SLICES + 1):
            part = records.where(F.col("slice") == i).drop("slice").coalesce(1)
            part.write.mode("append").parquet(path)
        paths[name] = path
    return paths


def _by_arrival():
    from pyspark.sql import Window

    return Window.orderBy(arrival())


def run(start, spark, path, out, checkpoint, **kwargs):
    query = start(read_stream(spark, path, max_files=1), out, checkpoint, trigger=NOW, fold_every=1, **kwargs)
    query.awaitTermination()
    return query


@pytest.fixture(scope="module")
def sense_out(spark, streams, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    run(jobs.start_sense, spark, streams["sense"], out, str(tmp_path_factory.mktemp("cp")), only=jobs.SENSE_TABLES)
    return out


@pytest.fixture(scope="module")
def pill_out(spark, streams, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    run(jobs.start_pill, spark, streams["pill"], out, str(tmp_path_factory.mktemp("cp")), only=jobs.PILL_TABLES)
    return out


@pytest.fixture(scope="module")
def sense(spark, streams):
    parsed = decode.parse(read_batch(spark, streams["sense"]), schemas.SENSE_MESSAGE).cache()
    return parsed, decode.sense_messages(parsed)


@pytest.fixture(scope="module")
def pill(spark, streams):
    parsed = decode.parse(read_batch(spark, streams["pill"]), schemas.PILL_MESSAGE).cache()
    return parsed, decode.pill_readings(decode.pill_messages(parsed))


def unexpired(hours):
    """Live members as of the last hour; a store may have dropped the others."""
    last = hours.agg(F.max("hour_start")).first()[0]
    return hours.where(F.col("hour_start") + 48 * 3_600_000 > last)


def last_hour(rows):
    return rows.agg(F.max("arrival_ms")).first()[0] // HOUR_MS


def rings(rows, out, name):
    return devices.turn_rings(devices.hour_rings(rows, "arrival_ms"), last_hour(rows))


def turned(found):
    return devices.turn_rings(found, found.agg(F.max("top_hour")).first()[0])


def test_live_hours_equal_batch_at_any_time(spark, sense_out, sense):
    """One row per device; what is read as of an hour holds no expired member."""
    stored, hours = jobs.read_table(spark, sense_out, "sense_rings"), devices.active_hours(sense[1], "arrival_ms")
    last = last_hour(sense[1])
    assert turned(stored).count() == turned(stored).select("device_id").distinct().count()
    for as_of in (last * HOUR_MS, last * HOUR_MS + 1, (last + 20) * HOUR_MS + 1234, (last + 47) * HOUR_MS, (last + 48) * HOUR_MS):
        live = devices.live(devices.with_hour_key(hours), as_of // 1000).select("hour_key", "device_id")
        found = devices.with_hour_key(jobs.live_hours(spark, sense_out, "sense_rings", as_of)).select("hour_key", "device_id")
        assert rows(found) == rows(live), as_of
    assert live.count() == 0


def test_expired_hours_leave_the_store(spark, sense_out, sense):
    stored = jobs.read_table(spark, sense_out, "sense_hours")
    everything = devices.active_hours(sense[1], "arrival_ms")
    assert 0 < stored.count() < everything.count()
    assert stored.join(everything, ["hour_start", "device_id"], "left_anti").count() == 0


def test_sense_tables_equal_batch(spark, sense_out, sense):
    parsed, messages = sense
    expected = {
        "sense_dead_letters": decode.dead_letters(parsed),
        "sense_state": devices.sense_state(messages),
        "firmware_versions": firmware.version_state(firmware.sense_firmware(messages)),
        "sense_hours": unexpired(devices.active_hours(messages, "arrival_ms")),
        "sense_rings": rings(messages, sense_out, "sense_rings"),
        "low_uptime": metrics.low_uptime_first(messages),
        "low_uptime_sketches": metrics.low_uptime_sketches(messages),
        "uptime_histogram": metrics.uptime_histogram(messages),
        "bad_sensor_events": quality.bad_sensor_events(messages),
        "sense_minutes": metrics.sense_meters(parsed, MINUTE_MS),
        jobs.SENSE_POSITIONS: positions.kept_positions(positions.sense_times(messages)),
    }
    assert set(expected) == set(jobs.SENSE_TABLES)
    for name, table in expected.items():
        found = jobs.read_table(spark, sense_out, name)
        found = unexpired(found) if name in jobs.HOUR_TABLES else found
        found = turned(found) if name == "sense_rings" else found
        if name == "low_uptime_sketches":
            found, table = metrics.sketched_devices(found), metrics.sketched_devices(table)
        columns = sorted(table.columns)
        assert sorted(found.columns) == columns, name
        assert rows(found, *columns) == rows(table, *columns), name


def test_pill_tables_equal_batch(spark, pill_out, pill):
    parsed, readings = pill
    expected = {
        "pill_dead_letters": decode.dead_letters(parsed),
        "pill_state": devices.pill_state(readings),
        "pill_hours": unexpired(devices.active_hours(readings, "arrival_ms")),
        "pill_minutes": metrics.pill_meters(parsed, MINUTE_MS),
        "pill_rings": rings(readings, pill_out, "pill_rings"),
        jobs.PILL_POSITIONS: positions.kept_positions(positions.pill_times(readings)),
    }
    assert set(expected) == set(jobs.PILL_TABLES)
    for name, table in expected.items():
        found = jobs.read_table(spark, pill_out, name)
        found = unexpired(found) if name in jobs.HOUR_TABLES else found
        found = turned(found) if name == "pill_rings" else found
        columns = sorted(table.columns)
        assert rows(found, *columns) == rows(table, *columns), name


def test_positions_are_published(spark, sense_out, sense, pill_out, pill):
    jobs.publish_positions(spark, sense_out, jobs.SENSE_POSITIONS, "senses", "published")
    jobs.publish_positions(spark, pill_out, jobs.PILL_POSITIONS, "pills", "published")
    jobs.publish_positions(spark, sense_out, jobs.SENSE_POSITIONS, "senses", "published")
    batch = positions.checkpoint_track(positions.kept_positions(positions.sense_times(sense[1])), "senses").unionByName(
        positions.checkpoint_track(positions.kept_positions(positions.pill_times(pill[1])), "pills")
    )
    assert rows(spark.table("published")) == rows(batch)
    spark.sql("DROP TABLE published")


def test_folders_are_folded(spark, sense_out):
    names = changes.folders(spark, f"{sense_out}/sense_state")
    assert any(n.startswith("f") for n in names) and changes.batch_folder(SLICES - 1) in names


def test_restart_goes_on_from_the_checkpoint(spark, streams, sense, tmp_path):
    import glob
    import os
    import shutil

    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    os.mkdir(source)
    files = sorted(glob.glob(f"{streams['sense']}/part-*"), key=os.path.getmtime)
    for half in (files[:2], files[2:]):
        for file in half:
            shutil.copy2(file, source)
        run(jobs.start_sense, spark, source, out, checkpoint, only=["sense_state", "sense_minutes", jobs.SENSE_POSITIONS])
    parsed, messages = sense
    columns = ["metric", "window_start", "events"]
    assert rows(jobs.read_table(spark, out, "sense_minutes"), *columns) == rows(
        metrics.sense_meters(parsed, MINUTE_MS), *columns
    )
    columns = ["device_id", *devices.SENSE_STATE]
    assert rows(jobs.read_table(spark, out, "sense_state"), *columns) == rows(devices.sense_state(messages), *columns)
    columns = ["shard_id", "ts", "sequence_number"]
    assert rows(jobs.read_table(spark, out, jobs.SENSE_POSITIONS), *columns) == rows(
        positions.kept_positions(positions.sense_times(messages)), *columns
    )


def test_failed_batch_is_repeated_without_loss(spark, streams, sense, tmp_path, monkeypatch):
    """The third batch fails after its first tables were written; the restart repeats it."""
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    original, calls = changes.write, []

    def flaky(table, path, batch_id):
        if batch_id == 2 and path.endswith("/sense_positions") and not calls:
            calls.append(path)
            raise OSError("lost")
        original(table, path, batch_id)

    monkeypatch.setattr(changes, "write", flaky)
    only = ["sense_minutes", "uptime_histogram", jobs.SENSE_POSITIONS]
    with pytest.raises(Exception, match="lost"):
        run(jobs.start_sense, spark, streams["sense"], out, checkpoint, only=only)
    run(jobs.start_sense, spark, streams["sense"], out, checkpoint, only=only)
    parsed, messages = sense
    assert calls
    for name, table in {
        "sense_minutes": metrics.sense_meters(parsed, MINUTE_MS),
        "uptime_histogram": metrics.uptime_histogram(messages),
        jobs.SENSE_POSITIONS: positions.kept_positions(positions.sense_times(messages)),
    }.items():
        columns = sorted(table.columns)
        assert rows(jobs.read_table(spark, out, name), *columns) == rows(table, *columns), name


def test_changes_repeat_and_fold(spark, tmp_path):
    path = str(tmp_path / "t")

    def reduce(table):
        return table.groupBy("k").agg(F.max("v").alias("v"))

    def frame(*data):
        return spark.createDataFrame(data, "k string, v int")

    changes.write(frame(("a", 9)), path, 0)
    changes.write(frame(("a", 1), ("b", 2)), path, 0)
    changes.write(frame(("a", 3)), path, 1)
    changes.write(frame(("c", 4)), path, 2)
    want = [("a", 3), ("b", 2), ("c", 4)]
    assert rows(changes.read(spark, path, reduce), "k", "v") == want
    assert changes.live(spark, path, 1) == [changes.batch_folder(0), changes.batch_folder(1)]
    changes.fold(spark, path, 1, reduce)
    assert rows(changes.read(spark, path, reduce), "k", "v") == want
    changes.write(frame(("b", 7)), path, 3)
    changes.fold(spark, path, 2, reduce)
    changes.fold(spark, path, 2, reduce)
    assert changes.folders(spark, path) == sorted(
        [f"b{2:012d}", f"b{3:012d}", f"f{1:012d}", f"f{2:012d}"]
    )
    assert rows(changes.read(spark, path, reduce), "k", "v") == [("a", 3), ("b", 7), ("c", 4)]


def test_folds_add_up(spark, tmp_path):
    """A reduction that sums counts every row once, before, during and after a fold, and folded rows are as few as their keys."""
    path = str(tmp_path / "t")

    def add(table):
        return table.groupBy("k").agg(F.sum("v").alias("v"))

    for batch in range(9):
        changes.write(spark.createDataFrame([("a", 1), ("b", batch)], "k string, v long"), path, batch)
        if batch % 3 == 2:
            changes.fold(spark, path, batch - 1, add)
            changes.fold(spark, path, batch - 1, add)
        assert rows(changes.read(spark, path, add), "k", "v") == [("a", batch + 1), ("b", sum(range(batch + 1)))]
    folded = [n for n in changes.live(spark, path) if n.startswith("f")]
    assert len(folded) == 1 and spark.read.parquet(f"{path}/folder={folded[0]}").count() == 2


def test_interrupted_fold_loses_nothing(spark, tmp_path):
    """A fold that failed, or whose driver was lost before the commit, is done again from its sources."""
    path = str(tmp_path / "t")

    def reduce(table):
        return table.groupBy("k").agg(F.max("v").alias("v"))

    def failing(table):
        return reduce(table).where(F.raise_error(F.lit("lost")).isNull())

    for batch in range(8):
        changes.write(spark.createDataFrame([(f"d{batch}", batch)], "k string, v int"), path, batch)
        if batch == 3:
            with pytest.raises(Exception, match="lost"):
                changes.fold(spark, path, 2, failing)
            (tmp_path / "t" / f"folder=f{2:012d}" / "_temporary").mkdir(parents=True, exist_ok=True)
        if batch in (3, 5, 7):
            changes.fold(spark, path, batch - 1, reduce)
        want = [(f"d{b}", b) for b in range(batch + 1)]
        assert rows(changes.read(spark, path, reduce), "k", "v") == want


def test_a_wrong_arrival_removes_no_live_member(spark, tmp_path):
    import json
    import time

    now = int(time.time() * 1000)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, ahead in enumerate((0, 0, 100, 0, 0)):
        record = [("s", str(i), now + ahead * 3_600_000, json.dumps(message(f"d{i}", now)))]
        columns = "shard_id string, sequence_number string, arrival_ms long, payload string"
        spark.createDataFrame(record, columns).coalesce(1).write.mode("append").parquet(source)
    run(jobs.start_sense, spark, source, out, str(tmp_path / "cp"), only=["sense_hours"])
    found = jobs.read_table(spark, out, "sense_hours")
    assert [r[0] for r in rows(found.select("device_id"), "device_id")] == [f"d{i}" for i in range(5)]


def test_native_update_mode(spark, streams, sense, tmp_path):
    """The batch operator on a stream; the last update of a device is its batch row."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    messages = decode.decode_sense(read_stream(spark, streams["sense"], max_files=1))
    path = str(tmp_path / "updates")
    query = (
        devices.sense_state(messages)
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: changes.write(batch, path, batch_id))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(**NOW)
        .start()
    )
    query.awaitTermination()
    latest = jobs.SENSE_TABLES["sense_state"].reduce
    columns = ["device_id", *devices.SENSE_STATE]
    assert rows(changes.read(spark, path, latest), *columns) == rows(devices.sense_state(sense[1]), *columns)


def test_start_position_skips_older_records(spark, tmp_path):
    path = str(tmp_path / "in")
    raw(spark, message("old"), arrival_ms=1_000).unionByName(raw(spark, message("new"), arrival_ms=2_000)).write.parquet(path)
    query = jobs.start_sense(
        read_stream(spark, path, start_ms=1_500), str(tmp_path / "out"), str(tmp_path / "cp"), ["sense_state"], NOW
    )
    query.awaitTermination()
    assert rows(jobs.read_table(spark, str(tmp_path / "out"), "sense_state"), "device_id") == [("new",)]


def test_checkpoint_table_is_created_once(spark):
    create_checkpoint_table(spark, "track")
    create_checkpoint_table(spark, "track")
    assert spark.table("track").columns == ["stream_shard_id", "created_at", "checkpoint"]
    spark.sql("DROP TABLE track")


def test_decoded_table_is_read_by_column(spark, sense, tmp_path, capsys):
    path = str(tmp_path / "decoded")
    write_decoded(sense[1], path)
    stored = read_decoded(spark, path)
    assert rows(devices.active_senses(stored)) == rows(devices.active_senses(sense[1]))
    wanted = {
        "wave_count": metrics.wave_counts(stored),
        "unix_time": positions.kept_positions(positions.sense_times(stored)),
        "firmware_version": firmware.firmwares_seen(firmware.sense_firmware(stored)),
    }
    for field, table in wanted.items():
        capsys.readouterr()
        table.explain("formatted")
        schema = next(line for line in capsys.readouterr().out.splitlines() if line.startswith("ReadSchema"))
        assert field in schema and "co2" not in schema and "scan" not in schema


def test_scratch_needs_a_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
