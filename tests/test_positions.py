import random

import pytest
from helpers import message, point, rows, sense
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetmeter.operators import positions

PERIOD, AHEAD, DAY = 300_000, 3_600_000, 86_400_000
TIMES = "shard_id string, sequence_number string, position int, clock_ms long, ts long"


def plain_fold(records):
    """The rule, one record after the other, for one shard."""
    kept, last = [], 0
    for sequence, _, clock, ts in sorted(records, key=lambda r: (len(r[0]), r[0], r[1])):
        if ts > last + PERIOD and ts < clock + AHEAD:
            last = ts
            kept.append((ts, sequence))
    return kept


def kept(spark, shards):
    data = [(s, *r) for s, records in shards.items() for r in records]
    return rows(positions.kept_positions(spark.createDataFrame(data, TIMES)))


def expected(shards):
    return sorted(
        ((s, ts, n) for s, records in shards.items() for ts, n in plain_fold(records)),
        key=lambda r: [(False, str(v)) for v in r],
    )


def walk(rng, n, start=3 * DAY):
    """Mostly forward in time, with late, far-future and repeated readings."""
    records, now = [], start
    for i in range(n):
        now += rng.choice([0, 1000, 60_000, 299_000, 301_000, 3_600_000])
        jitter = rng.choice([0, 0, 0, -1_800_000, 7_200_000, -DAY, 3_599_000])
        records.append((str(8 + i // 3), i % 3, now, now + jitter))
    return records


@pytest.mark.parametrize("seed", range(4))
def test_equals_plain_fold(spark, seed):
    rng = random.Random(seed)
    shards = {f"s{i}": walk(rng, rng.choice([1, 50, 800])) for i in range(5)}
    assert kept(spark, shards) == expected(shards)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 3 * DAY // 1000), min_size=1, max_size=60))
def test_equals_plain_fold_on_any_order(spark, seconds):
    shards = {"s": [(str(i), 0, 10 * DAY, s * 1000) for i, s in enumerate(seconds)]}
    assert kept(spark, shards) == expected(shards)


def test_staircases_of_batches_merge_in_any_order(spark):
    """Whichever batch a record is in, merged once or twice: the fold over the merged state equals the fold over all records."""
    rng = random.Random(11)
    records = walk(rng, 600)
    for parts in (2, 5):
        dealt = [[] for _ in range(parts)]
        for record in records:
            dealt[rng.randrange(parts)].append(record)
        states = [positions.candidates(spark.createDataFrame([("s", *r) for r in part], TIMES)) for part in reversed(dealt)]
        merged = states[0]
        for state in [*states[1:], states[0]]:
            merged = positions.reduce_candidates(merged.unionByName(state))
        assert rows(positions.thinned(merged)) == expected({"s": records})
        assert merged.count() < len(records)


def test_bounds_are_strict(spark):
    base = 10 * DAY
    records = [("1", 0, base, base), ("2", 0, base, base + PERIOD), ("3", 0, base, base + PERIOD + 1)]
    ahead = [("1", 0, base, base + AHEAD), ("2", 0, base, base + AHEAD - 1)]
    assert kept(spark, {"a": records}) == [("a", base, "1"), ("a", base + PERIOD + 1, "3")]
    assert kept(spark, {"a": ahead}) == [("a", base + AHEAD - 1, "2")]


def test_track_rows(spark):
    messages = sense(spark, message("d", 1_700_000_000_000, [point(1_699_999_999), point(1_700_000_400)]))
    track = positions.checkpoint_track(positions.kept_positions(positions.sense_times(messages)), "stream")
    assert rows(track) == [
        ("stream:s0", "2023-11-14 22:13:19+0000", "1"),
        ("stream:s0", "2023-11-14 22:20:00+0000", "1"),
    ]


def test_long_shard_spans_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        shards = {"s": walk(random.Random(5), 400), "t": walk(random.Random(6), 30)}
        assert kept(spark, shards) == expected(shards)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
