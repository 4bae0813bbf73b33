from functools import reduce

from helpers import message, point, readings, rows, sense
from pyspark.sql import DataFrame

from fleetmeter.operators import devices, metrics, quality


def test_last_arrival_wins_over_newer_value(spark):
    messages = sense(spark, message("a", 2_000, uptime_in_second=7), message("a", 1_000, uptime_in_second=9))
    assert rows(devices.active_senses(messages)) == [("a", 1_000)]
    assert rows(devices.sense_uptimes(messages)) == [("a", 9)]


def test_sequence_numbers_compare_by_length_first(spark):
    wide = "9" * 55
    messages = sense(
        spark,
        ("1" + "0" * 55, message("a", 3)),
        (wide, message("a", 2)),
        ("999999999", message("b", 1)),
        ("1000000000", message("b", 4)),
    )
    assert rows(devices.active_senses(messages)) == [("a", 3), ("b", 4)]


def test_last_pill_reading_of_a_message_wins(spark):
    pills = readings(
        spark, {"pills": [{"device_id": "p", "timestamp": 9}, {"device_id": "p", "timestamp": 5}]}
    )
    assert rows(devices.active_pills(pills)) == [("p", 5_000)]


def test_wifi(spark):
    scan = [{"ssid": "x", "rssi": -1}, {"ssid": "n", "rssi": -40}, {"ssid": "n", "rssi": -90}]
    hidden = [{"ssid": "x", "rssi": -1}, {"ssid": "", "rssi": -60}]
    unnamed = [{"rssi": -70}]
    messages = sense(
        spark,
        message("connected", scan=scan, ssid="n"),
        message("unseen", scan=scan, ssid="other"),
        message("none"),
        message("hidden", scan=hidden),
        message("unnamed", scan=unnamed),
        message("zero", scan=[{"ssid": "n"}], ssid="n"),
    )
    assert rows(devices.wifi_info(messages)) == [
        ("connected", "n", -40, "n : -40", True),
        ("hidden", "", -60, " : -60", False),
        ("none", "", 0, " : 0", False),
        ("unnamed", "", -70, " : -70", False),
        ("unseen", "other", 0, "other : 0", False),
        ("zero", "n", 0, "n : 0", False),
    ]


def test_hourly_sets_and_expiry(spark):
    hour = 1_699_999_200_000  # 2023-11-14 22:00 UTC
    arrivals = (hour, hour + 3_599_999, hour + 3_600_000)
    messages = reduce(
        DataFrame.unionByName,
        [sense(spark, message("a", at), arrival_ms=arrived) for at, arrived in zip((0, None, hour * 2), arrivals, strict=True)],
    )  # the hour is that of the arrival, whatever the record says
    hourly = devices.hourly_active_sense(messages)
    expire = hour // 1000 + 48 * 3600
    assert rows(hourly) == [
        ("2023_11_14_22_00", "a", expire),
        ("2023_11_14_23_00", "a", expire + 3600),
    ]
    assert devices.live(hourly, expire - 1).count() == 2
    assert devices.live(hourly, expire).count() == 1
    assert devices.live(hourly, expire + 3600).count() == 0


def test_low_uptime_bound_is_inclusive(spark):
    hour = 1_699_999_200_000
    messages = sense(
        spark,
        message("a", 0, uptime_in_second=3600),
        message("a", 1, uptime_in_second=0),
        message("b", uptime_in_second=3601),
        message("c", 2 * hour),
        arrival_ms=hour,
    ).unionByName(sense(spark, message("a", uptime_in_second=1), arrival_ms=hour + 3_600_000))
    assert rows(metrics.low_uptime_devices(messages)) == [("s0", hour, 2), ("s0", hour + 3_600_000, 1)]
    sketched = metrics.low_uptime_devices_approx(messages).where("shard_id = 's0' AND period_hours = 1")
    assert rows(sketched, "period_start", "devices") == [(hour, 2), (hour + 3_600_000, 1)]


def test_uptime_distribution(spark):
    day = 86_400
    messages = sense(spark, *[message("a", uptime_in_second=u) for u in (0, day - 1, day, 3 * day + 5, -day - 1)])
    row = metrics.uptime_days(messages).first()
    assert (row.messages, row.min_days, row.max_days) == (5, -1, 3)
    assert row.mean_days == 0.6 and row.p50 == 0.0 and row.p75 == 1.0
    assert row.stddev_days == round((((-1.6) ** 2 + 2 * 0.6**2 + 0.4**2 + 2.4**2) / 4) ** 0.5, 6)


def test_distribution_of_one_message(spark):
    row = metrics.uptime_days(sense(spark, message("a", uptime_in_second=86_400))).first()
    assert row.p999 == 1.0 and row.stddev_days is None


def counts(messages):
    return {m: n for m, n in rows(quality.data_quality_counts(messages), "meter", "events") if n}


def test_thresholds_are_strict(spark):
    bounds = [
        ("co2", 400, 3500, "low-co2", "high-co2"),
        ("pressure", 23_040_000, 27_801_600, "low-pa", "high-pa"),
        ("humidity", 100, 9900, "low-hum", "high-hum"),
        ("temperature", 0, 10_000, "low-tmp", "high-tmp"),
    ]
    at, beyond, expected = [], [], {}
    for field, low, high, low_meter, high_meter in bounds:
        at += [point(**{field: low}), point(**{field: high})]
        beyond += [point(**{field: low - 1}), point(**{field: high + 1})]
        expected |= {low_meter: 1, high_meter: 1}
    newer = {"light_sensor": {"uv_count": 6}}
    at += [point(dust=1500), point(**newer), point(**newer, light=100_000), point(light=4_194_304), point()]
    beyond += [
        point(dust=1501),
        point(light_sensor={"uv_count": 7}),
        point(**newer, light=100_001),
        point(light=4_194_305),
        point(light_sensor={}, light=100_001),
    ]
    expected |= {"high-dust": 1, "high-uv": 1, "high-lux": 3}
    assert counts(sense(spark, message("a", points=at))) == {}
    assert counts(sense(spark, message("a", points=beyond))) == expected
    assert quality.data_quality_counts(sense(spark, message("a"))).count() == 12


def test_bad_reading_log(spark):
    messages = sense(
        spark,
        message("a", points=[point(), point(dust=1600, light_sensor={"uv_count": 9}, firmware_version=5)]),
        message("b", points=[point(co2=1)], batch_fw=77),
    )
    assert rows(
        quality.bad_sensor_events(messages), "device_id", "position", "sensor", "value", "fw_version"
    ) == [("a", 1, "dust", 1600, 0), ("a", 1, "uv", 9, 0), ("b", 0, "co2", 1, 77)]


def test_wave_counts(spark):
    messages = sense(spark, message("a", points=[point(wave_count=2), point()]), message("b"))
    assert metrics.wave_counts(messages).first()["wave_count"] == 2
    assert metrics.wave_counts(sense(spark, message("b"))).first()["wave_count"] == 0
