import json

import pytest
from helpers import message, point, raw, readings, rows, sense

from fleetmeter import schemas
from fleetmeter.operators import metrics
from fleetmeter.sources import decode
from fleetmeter.sources.raw import from_broker

GOOD = message("a", points=[point()])
BAD = ["{bad", None, "", '{"received_at": "text"}', '{"data": {"data": [{"co2": "x"}]}}', "17"]


@pytest.mark.parametrize("payload", BAD)
def test_malformed_record_is_set_aside(spark, payload):
    parsed = decode.parse(raw(spark, GOOD, payload, GOOD), schemas.SENSE_MESSAGE)
    assert rows(decode.dead_letters(parsed), "sequence_number", "payload") == [("2", payload)]
    assert rows(decode.sense_messages(parsed), "sequence_number") == [("1",), ("3",)]


def test_malformed_records_count_as_processed(spark):
    records = raw(spark, GOOD, *BAD)
    assert metrics.messages_processed(records).first()["messages"] == 1 + len(BAD)


def test_absent_fields_take_their_default(spark):
    row = sense(spark, {}).first()
    assert (row.device_id, row.uptime_seconds, row.received_at, row.middle_version) == ("", 0, 0, "")
    assert row.top_version is None and row.batch_firmware is None and row.connected_ssid is None
    assert metrics.low_uptime_devices(sense(spark, {})).first()["devices"] == 1


def test_messages_without_elements_give_no_rows(spark):
    messages = sense(spark, message("a"), {"data": {"device_id": "b"}}, {})
    assert decode.sense_points(messages, "device_id").count() == 0
    assert readings(spark, {"pills": []}, {}).count() == 0


def test_pill_default_fields(spark):
    assert rows(readings(spark, {"pills": [{}]}), "device_id", "seen_at") == [("", 0)]


def test_binary_payload(spark):
    records = raw(spark, GOOD).selectExpr("shard_id", "sequence_number", "arrival_ms", "CAST(payload AS BINARY) payload")
    assert rows(decode.decode_sense(records), "device_id") == [("a",)]


def test_broker_rows(spark):
    source = spark.sql("SELECT 3 AS partition, 42L AS offset, timestamp_millis(1700000000123) AS timestamp, X'7B7D' AS value")
    assert rows(from_broker(source), "shard_id", "sequence_number", "arrival_ms") == [
        ("shardId-000000000003", "42", 1_700_000_000_123)
    ]
    assert decode.decode_sense(from_broker(source)).count() == 1


def test_payload_is_parsed_once(spark, capsys):
    decode.sense_messages(decode.parse(raw(spark, GOOD), schemas.SENSE_MESSAGE)).explain()
    assert capsys.readouterr().out.count("from_json(") == 1


def test_a_payload_is_exactly_one_object(spark):
    good = json.dumps(message("d"))
    bad = [f"{good} junk", f"{good}{good}", f"{good}, {good}", f'{good}, "x": {good}', f'{good}, "m": {good}', f"{good}}} junk"]
    bad += [f'{good}, "z": 1}} junk', "", "null", f"[{good}]", '{"received_at": "x"}', "3", None]
    parsed = decode.parse(raw(spark, *bad, good, f" {good} \n"), schemas.SENSE_MESSAGE)
    flags = [r["malformed"] for r in sorted(parsed.collect(), key=lambda r: int(r["sequence_number"]))]
    assert flags == [True] * len(bad) + [False] * 2


def test_text_that_closes_the_wrapping_is_no_message(spark):
    good = json.dumps(message("d"))
    bad = [f'{good}],"m":[{good}', f'{good}],"m":[{{"_mark":0}},{good},{{"_mark":0}}', f"{good}]}}", f"{good},{good}", f"[{good}]"]
    parsed = decode.parse(raw(spark, *bad, good), schemas.SENSE_MESSAGE)
    assert rows(decode.sense_messages(parsed), "sequence_number") == [(str(len(bad) + 1),)]
