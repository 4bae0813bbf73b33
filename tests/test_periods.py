import random

from helpers import rows

from fleetmeter.operators import periods

HOUR = 3_600_000


def plain(arrivals):
    out = []
    for shard in {s for s, _ in arrivals}:
        start = None
        for at in sorted(a for s, a in arrivals if s == shard):
            if start is None or at > start + HOUR:
                start = at
                out.append((shard, at))
    return sorted(out, key=lambda r: [(False, str(v)) for v in r])


def frame(spark, arrivals):
    return spark.createDataFrame(arrivals, "shard_id string, arrival_ms long")


def test_equals_a_walk(spark):
    rng = random.Random(2)
    arrivals = []
    for shard, many, gap in (("a", 400, HOUR // 7), ("b", 150, 2 * HOUR), ("c", 60, HOUR), ("d", 1, 1)):
        at = rng.randrange(HOUR)
        for _ in range(many):
            at += rng.choice([0, 1, gap, gap + 1, rng.randrange(gap + 1), HOUR, 5 * HOUR if rng.random() < 0.05 else 0])
            arrivals.append((shard, at))
    arrivals += arrivals[:50]
    assert rows(periods.beginnings(frame(spark, arrivals))) == plain(arrivals)


def test_the_end_of_a_period_is_its_own(spark):
    arrivals = [("s", 10), ("s", 10 + HOUR), ("s", 11 + HOUR), ("s", 11 + 2 * HOUR), ("s", 12 + 2 * HOUR), ("s", 50 * HOUR)]
    assert rows(periods.beginnings(frame(spark, arrivals))) == plain(arrivals) == sorted(
        [("s", 10), ("s", 11 + HOUR), ("s", 12 + 2 * HOUR), ("s", 50 * HOUR)], key=lambda r: str(r[1])
    )
    messages = spark.createDataFrame(
        [("s", 10, "a", 60), ("s", 10 + HOUR, "a", 60), ("s", 10 + HOUR, "b", 3600), ("s", 11 + HOUR, "a", 0), ("s", 50 * HOUR, "a", 3601)],
        "shard_id string, arrival_ms long, device_id string, uptime_seconds int",
    )
    found = periods.low_uptime_devices_chained(frame(spark, arrivals), messages)
    assert rows(found, "period_start", "devices") == sorted([(10, 2), (11 + HOUR, 1)], key=lambda r: str(r[0]))
    assert periods.beginnings(frame(spark, arrivals).limit(0)).count() == 0
