import pytest
from helpers import message, point, raw, rows

from fleetmeter import schemas
from fleetmeter.operators import metrics
from fleetmeter.sources import decode


def test_include_list():
    names = ["sense.low-co2", "sense.high-co2", "pill.messages-processed"]
    assert metrics.included(names, None) == names
    assert metrics.included(names, ["co2$", "^pill"]) == names
    assert metrics.included(names, ["^low"]) == []


@pytest.mark.parametrize("seconds", [4, 121])
def test_interval_is_checked(spark, seconds):
    records = raw(spark, {})
    parsed = decode.parse(records, schemas.SENSE_MESSAGE)
    with pytest.raises(ValueError):
        metrics.metrics_report(parsed, decode.sense_messages(parsed), records, None, seconds)


def test_report(spark):
    at = 1_700_000_010_000
    payloads = [message("a", at, [point(wave_count=3), point(co2=1)], uptime_in_second=86_400), "{bad", message("b", at)]
    records = raw(spark, *payloads, arrival_ms=at)
    parsed = decode.parse(records, schemas.SENSE_MESSAGE)
    args = (parsed, decode.sense_messages(parsed), records)
    start = at - at % 30_000
    assert rows(metrics.metrics_report(*args, ["messages-processed", "low-"])) == [
        ("pill.messages-processed.count", start, 3.0),
        ("pill.messages-processed.rate", start, 0.1),
        ("sense.low-co2.count", start, 1.0),
        ("sense.low-co2.rate", start, 0.033333),
        ("sense.low-uptime.count", start, 1.0),
        ("sense.low-uptime.rate", start, 0.033333),
        ("sense.messages-processed.count", start, 3.0),
        ("sense.messages-processed.rate", start, 0.1),
    ]
    everything = dict((m, v) for m, _, v in rows(metrics.metrics_report(*args)))
    assert everything["sense.wave-counts.count"] == 3.0
    assert everything["sense.uptime-days.max"] == 1.0 and everything["sense.uptime-days.p50"] == 0.5
    assert rows(metrics.metrics_report(*args, ["nothing"])) == []


def test_rates_roll_up(spark):
    minutes = spark.createDataFrame(
        [("m", 0, 6), ("m", 60_000, 3), ("m", 300_000, 9)], "metric string, window_start long, events long"
    )
    assert rows(metrics.meter_rates(minutes), "window_minutes", "window_start", "events", "rate") == [
        (1, 0, 6, 0.1),
        (1, 300_000, 9, 0.15),
        (1, 60_000, 3, 0.05),
        (15, 0, 18, 0.02),
        (5, 0, 9, 0.03),
        (5, 300_000, 9, 0.03),
    ]


def test_sketches_of_thousands(spark):
    """Estimates stay within five standard errors for groups of thousands, rolled up over shards and periods, merged twice."""
    low = spark.range(60_000).selectExpr(
        "concat('s', id % 3) AS shard_id", "(id % 48) * 3600000 AS arrival_ms",
        "concat('d', id % 20000) AS device_id", "IF(id % 5 = 0, 99999, 60) AS uptime_seconds",
    )
    parts = [metrics.low_uptime_sketches(low.where(f"arrival_ms % 7 {op} 3")) for op in ("<", ">=", "<")]
    merged = metrics.merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    found = {(r.shard_id, r.period_hours, r.period_start): r.devices for r in metrics.sketched_devices(merged).collect()}
    exact = {}
    for r in low.where("uptime_seconds <= 3600").collect():
        for shard in (r.shard_id, "all"):
            for hours in metrics.SKETCH_PERIODS:
                start = r.arrival_ms - r.arrival_ms % (hours * 3_600_000)
                exact.setdefault((shard, hours, start), set()).add(r.device_id)
    assert set(found) == set(exact)
    assert max(len(d) for d in exact.values()) >= 16_000
    assert all(abs(found[k] - len(d)) <= max(1, 0.08 * len(d)) for k, d in exact.items())
    thousands = [abs(found[k] - len(d)) / len(d) for k, d in exact.items() if len(d) >= 1000]
    assert len(thousands) >= 10 and sum(thousands) / len(thousands) < 0.03
