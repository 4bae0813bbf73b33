"""Hand-made messages and row comparison."""

import json

from fleetmeter import schemas
from fleetmeter.sources import decode


def point(unix_time=1_700_000_000, **fields):
    return {"unix_time": unix_time, **fields}


def message(device="d", received_at=1_700_000_000_000, points=(), scan=(), ssid=None, batch_fw=None, **top_level):
    data = {"device_id": device, "data": list(points), "scan": list(scan)}
    if ssid is not None:
        data["connected_ssid"] = ssid
    if batch_fw is not None:
        data["firmware_version"] = batch_fw
    return {"received_at": received_at, "data": data, **top_level}


def raw(spark, *payloads, shard="s0", arrival_ms=1_700_000_000_000, first=1):
    """Raw records in arrival order; a str payload is taken as is, a tuple is (sequence, payload)."""
    rows = []
    for number, payload in enumerate(payloads, first):
        sequence = str(number)
        if isinstance(payload, tuple):
            sequence, payload = payload
        text = payload if payload is None or isinstance(payload, str) else json.dumps(payload)
        rows.append((shard, sequence, arrival_ms, text))
    return spark.createDataFrame(rows, schemas.RAW)


def sense(spark, *payloads, **kwargs):
    return decode.decode_sense(raw(spark, *payloads, **kwargs))


def readings(spark, *payloads, **kwargs):
    return decode.pill_readings(decode.decode_pill(raw(spark, *payloads, **kwargs)))


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
