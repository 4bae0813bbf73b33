"""Example streams: sense and pill records derived from the ``events`` table (see FIXTURES.md).

One message stands for the events of one user on one day, at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.functions.clock import utc_session


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` reduced to the columns the derivation reads."""
    utc_session(spark)
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    return table.select(
        "event_id",
        "user_id",
        "event_type",
        F.to_date("ts").alias("day"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        F.regexp_extract("props", r'"k"\s*:\s*(\d+)', 1).try_cast("int").alias("k"),
    )


# Formulas of FIXTURES.md, per event; a null field is left out of the JSON.
_UNIX_TIME = "ms div 1000 + CASE WHEN k % 10 = 0 THEN 7200 WHEN k % 7 = 0 THEN -1800 ELSE 0 END"

_SENSE_POINT = f"""
named_struct(
  'unix_time', {_UNIX_TIME},
  'wave_count', CASE WHEN event_type <> 'view' THEN k % 4 END,
  'co2', CASE WHEN k % 3 <> 0 THEN 300 + 50 * k END,
  'pressure', CASE WHEN event_type IN ('click', 'purchase') THEN (890 + 2 * k) * 25600 END,
  'light_sensor', CASE WHEN event_type IN ('purchase', 'view') THEN named_struct('uv_count', k % 9) END,
  'light', CASE event_type WHEN 'view' THEN 1250 * k WHEN 'error' THEN 50000 * k END,
  'dust', CASE WHEN event_type <> 'signup' THEN 20 * k END,
  'humidity', int(100 * k + 50 * (user_id % 3)),
  'temperature', 125 * k - 125,
  'firmware_version', 90 + k % 4)
"""

_SCAN_ENTRY = "named_struct('ssid', concat('ssid-', k % 5), 'rssi', -30 - k % 60)"

_PILL = f"named_struct('device_id', concat('pill-', 2 * user_id + k % 2), 'timestamp', {_UNIX_TIME})"

# Per message; ``last`` is the event with the greatest id.
_SENSE_PAYLOAD = """
named_struct(
  'uptime_in_second', 100 * last.k * last.k,
  'received_at', CASE WHEN seq % 31 <> 0 THEN arrival_ms + (seq % 5 - 2) * 2700000 END,
  'firmware_top_version',
    CASE last.event_type WHEN 'error' THEN NULL WHEN 'signup' THEN '0' ELSE concat('1.', last.k % 4) END,
  'firmware_middle_version', CASE WHEN last.k % 9 = 0 THEN '0' ELSE concat('mid', 200 + last.k % 5) END,
  'data', named_struct(
    'device_id', concat('sense-', user_id),
    'firmware_version', CASE WHEN user_id % 10 <> 0 THEN int(100 + user_id % 7) END,
    'connected_ssid', CASE WHEN last.event_type <> 'error' THEN concat('ssid-', user_id % 5) END,
    'scan', events.entry,
    'data', events.point))
"""

# Records that are no message: cut off, with text after the message, two messages.
_MALFORMED = """WHEN seq % 97 = 0 THEN '{bad' WHEN seq % 89 = 0 THEN '{"uptime_in_second":1} late'
  WHEN seq % 83 = 0 THEN '{}{}'"""

_PILL_PAYLOAD = "named_struct('pills', events.pill)"


def _messages(rows: DataFrame, parts: dict[str, str]) -> DataFrame:
    """Gather the events of each message, ordered by id, with the message ``parts`` of every event.

    The parts are computed before the shuffle, in generated code; a lambda over the gathered array
    would be interpreted for every event. The explicit shuffle serves the grouping as well:
    map-side lists would not shrink the rows. It names the session's number of partitions: the JSON that follows is work for all
    cores, and adaptive execution would merge the partitions by their bytes.
    """
    keys = ["user_id", "day"]
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.selectExpr(
            "user_id",
            "day",
            "ms",
            "struct(event_id, k, event_type, " + ", ".join(f"{sql} AS {name}" for name, sql in parts.items()) + ") AS event",
        )
        .repartition(partitions, *keys)
        .groupBy(*keys)
        .agg(F.max("ms").alias("arrival_ms"), F.sort_array(F.collect_list("event")).alias("events"))
        .withColumn("last", F.element_at("events", -1))
        .select("user_id", "arrival_ms", "events", "last", F.col("last.event_id").alias("seq"))
    )


def _raw(messages: DataFrame, payload: str) -> DataFrame:
    return messages.selectExpr(
        "format_string('shardId-%012d', user_id % 4) AS shard_id",
        "CASE WHEN seq < 400 THEN string(seq) ELSE concat('4960', lpad(string(seq), 40, '0')) END AS sequence_number",
        "arrival_ms",
        f"CASE {_MALFORMED} ELSE to_json({payload}) END AS payload",
    )


def sense_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"point": _SENSE_POINT, "entry": _SCAN_ENTRY}
    return _raw(_messages(events(spark, sf_dir), parts), _SENSE_PAYLOAD)


def pill_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).where(F.col("event_type").isin("click", "view"))
    return _raw(_messages(rows, {"pill": _PILL}), _PILL_PAYLOAD)
