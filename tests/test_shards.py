"""The shard-log source: order, offsets, newest start, the cap of a fetch, restarts."""

import pytest
from conftest import SF_DIR
from helpers import rows

from fleetmeter import schemas
from fleetmeter.functions.arrival import arrival
from fleetmeter.sources import derived, shards

TICK = {"processingTime": "0 seconds"}


def records(spark, *numbers, shard="s0"):
    return spark.createDataFrame([(shard, str(n), n, f"p{n}") for n in numbers], schemas.RAW)


def run(spark, log, out, checkpoint, **options):
    """Until nothing is left; returns the progress of the batches that had rows."""
    stream = shards.read_stream(spark, log, checkpoint, **options)
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(**TICK).start()
    try:
        query.processAllAvailable()
        return [p for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()
        query.awaitTermination(30)


def test_every_record_once_and_no_fetch_over_the_cap(spark, tmp_path):
    raw = derived.sense_raw(spark, SF_DIR).cache()
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    shards.append(raw, log, 0)
    progress = run(spark, log, out, str(tmp_path / "cp"), records=30)
    assert rows(spark.read.parquet(out).select(raw.columns)) == rows(raw)
    assert len(progress) > 3
    for p in progress:
        start, end = shards.offsets(p)
        assert all(0 <= n - start.get(s, 0) <= 30 for s, n in end.items())


def test_a_shard_is_read_in_arrival_order(spark, tmp_path):
    log = str(tmp_path / "log")
    shards.append(records(spark, 10, 9, 100, 11), log, 0)
    shards.append(records(spark, 102, 101), log, 1)
    reader = shards.ShardReader(log, False, 4, str(tmp_path / "none"))
    first = reader.latestOffset()
    second = reader.latestOffset()
    assert (first, second) == ({"s0": 4}, {"s0": 6})
    found = []
    for start, end in (({}, first), (first, second), ({"s0": 3}, {"s0": 5})):
        found.append([v for f in reader.partitions(start, end) for b in reader.read(f) for v in b.column(1).to_pylist()])
    assert found == [["9", "10", "11", "100"], ["101", "102"], ["100", "101"]]


def test_newest_start_reads_nothing_older_and_restarts_go_on(spark, tmp_path):
    log, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "cp"))
    shards.append(records(spark, 1, 2, 3), log, 0)
    assert run(spark, log, out, checkpoint, start="newest", records=2) == []
    shards.append(records(spark, 4, 5, 6, 7, 8).unionByName(records(spark, 1, 2, shard="new")), log, 1)
    assert run(spark, log, out, checkpoint, start="newest", records=2)
    found = spark.read.parquet(out)
    assert rows(found, "shard_id", "sequence_number") == [("new", "1"), ("new", "2"), *(("s0", str(n)) for n in range(4, 9))]
    shards.append(records(spark, 9), log, 2)
    run(spark, log, out, checkpoint, start="newest", records=2)
    assert rows(spark.read.parquet(out).where("shard_id = 's0'").orderBy(arrival()), "arrival_ms") == [(n,) for n in range(4, 10)]


def test_options_are_checked(spark, tmp_path):
    for option in ({"records": 5001}, {"records": 0}, {"start": "middle"}):
        with pytest.raises(ValueError):
            shards.ShardLog({"path": str(tmp_path), "checkpoint": str(tmp_path), **{k: str(v) for k, v in option.items()}}).streamReader(None)


def test_a_batch_of_several_fetches_is_as_many_tasks(spark, tmp_path):
    log = str(tmp_path / "log")
    shards.append(records(spark, *range(1, 8)), log, 0)
    shards.append(records(spark, *range(8, 12)).unionByName(records(spark, 1, shard="s1")), log, 1)
    reader = shards.ShardReader(log, False, 2, str(tmp_path / "none"), 4)
    first, second = reader.latestOffset(), reader.latestOffset()
    assert (first, second) == ({"s0": 8, "s1": 1}, {"s0": 11, "s1": 1})
    fetches = reader.partitions({}, first) + reader.partitions(first, second)
    assert [(f.shard, sum(high - low for _, low, high in f.ranges)) for f in fetches] == [*[("s0", 2)] * 4, ("s1", 1), ("s0", 2), ("s0", 1)]
    found = [v for f in fetches if f.shard == "s0" for b in reader.read(f) for v in b.column(1).to_pylist()]
    assert found == [str(n) for n in range(1, 12)]
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    assert len(run(spark, log, out, checkpoint, records=2, fetches=4)) == 2
    assert spark.read.parquet(out).count() == 12
    with pytest.raises(ValueError):
        shards.ShardLog({"path": log, "checkpoint": checkpoint, "fetches": "0"}).streamReader(None)
