import random

from helpers import message, point, rows, sense

from fleetmeter.operators import firmware


def fw(spark, *messages):
    return firmware.sense_firmware(sense(spark, *messages))


def of_one(spark, payload):
    return rows(fw(spark, payload), "middle_version", "top_version", "timestamp")


def test_top_version_makes_the_message(spark):
    payload = message(
        "a", 5, [point(9, firmware_version=3)], firmware_top_version="1.2", firmware_middle_version="m", batch_fw=8
    )
    assert of_one(spark, payload) == [("m", "1.2", 5)]
    assert of_one(spark, message("a", 5, firmware_top_version="1.2")) == [("", "1.2", 5)]
    assert of_one(spark, message("a", 5, firmware_top_version="")) == [("", "", 5)]


def test_points_without_top_version(spark):
    points = [point(9, firmware_version=3), point(9, firmware_version=20), point(8, firmware_version=99)]
    assert of_one(spark, message("a", 5, points)) == [("3", "0", 9_000)]
    assert of_one(spark, message("a", 5, points, firmware_top_version="0")) == [("3", "0", 9_000)]
    assert of_one(spark, message("a", 5, points, batch_fw=8)) == [("8", "0", 9_000)]
    assert of_one(spark, message("a", 5, [point(9)])) == [("0", "0", 9_000)]
    assert of_one(spark, message("a", 5)) == []


def test_missing_top(spark):
    messages = sense(
        spark,
        message("none"),
        message("zero", firmware_top_version="0"),
        message("empty", firmware_top_version=""),
        message("ok", firmware_top_version="1.0"),
    )
    assert rows(firmware.missing_top_firmware(messages), "device_id") == [("none",), ("zero",)]


def test_parts_are_updated_independently(spark):
    top = {"firmware_top_version": "1.1"}
    updates = fw(
        spark,
        message("a", 10, firmware_middle_version="m1", **top),
        message("a", 20, firmware_middle_version="0", firmware_top_version="1.2"),
        message("a", 30, [point(7, firmware_version=4)]),
        message("b", 40, [point(6)]),
        message("c", 50, firmware_middle_version="0", **top),
    )
    assert rows(firmware.device_firmware(updates)) == [("a", "4", "1.2", 7_000), ("c", None, "1.1", 50)]


def test_version_history_is_kept(spark):
    updates = fw(
        spark,
        message("a", 90, firmware_middle_version="m1", firmware_top_version="1.1"),
        message("a", 20, firmware_middle_version="m2", firmware_top_version="1.1"),
        message("b", 10, firmware_middle_version="m1", firmware_top_version="0"),
    )
    assert rows(firmware.middle_firmware_devices(updates)) == [("m1", "a", 90), ("m2", "a", 20)]
    assert rows(firmware.top_firmware_devices(updates)) == [("1.1", "a", 20)]
    assert rows(firmware.top_firmwares_seen(updates)) == [("1.1", 20)]


def test_views_of_the_state_equal_the_direct_tables(spark):
    rng = random.Random(3)
    messages = []
    for _ in range(300):
        top = rng.choice([None, "0", "1.1", "1.2", "1.3"])
        extra = {} if top is None else {"firmware_top_version": top}
        points = [point(rng.randrange(1000), firmware_version=rng.randrange(4)) for _ in range(rng.randrange(4))]
        middle = rng.choice(["0", "m1", "m2"])
        messages.append(
            message(f"d{rng.randrange(8)}", rng.randrange(10**6), points, firmware_middle_version=middle, **extra)
        )
    updates = fw(spark, *messages).cache()
    first, second = updates.where("sequence_number % 2 = 0"), updates.where("sequence_number % 2 = 1")
    merged = firmware.version_state(first).unionByName(firmware.version_state(second))
    state = firmware.reduce_version_state(merged.unionByName(merged)).cache()
    assert rows(firmware.device_firmware_view(state)) == rows(firmware.device_firmware(updates))
    assert rows(firmware.seen_view(state, "middle")) == rows(firmware.firmwares_seen(updates))
    assert rows(firmware.seen_view(state, "top")) == rows(firmware.top_firmwares_seen(updates))
    assert rows(firmware.devices_view(state, "middle")) == rows(firmware.middle_firmware_devices(updates))
    assert rows(firmware.devices_view(state, "top")) == rows(firmware.top_firmware_devices(updates))
