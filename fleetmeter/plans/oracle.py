"""DuckDB SQL for every named query, written independently of the Spark plans.

The streams are derived from ``events`` again, in relational form: no JSON, no arrays. The state
queries use ``row_number`` and the position index a recursive fold.
"""

from __future__ import annotations

from fleetmeter.plans.streams import STREAMS

# Of a message: its shard, its sequence number as text, and its payload where that is no message.
_RECORD = """printf('shardId-%012d', user_id % 4) AS shard_id,
         CASE WHEN seq < 400 THEN CAST(seq AS VARCHAR) ELSE '4960' || lpad(CAST(seq AS VARCHAR), 40, '0') END AS seq_text,
         CASE WHEN seq % 97 = 0 THEN '{bad' WHEN seq % 89 = 0 THEN '{"uptime_in_second":1} late' WHEN seq % 83 = 0 THEN '{}{}'
         END AS bad_payload"""

# One row per event, one per message, one per data point; malformed messages are marked.
_BASE = """
WITH RECURSIVE ev AS (
  SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS d, epoch_us(ts) // 1000 AS ms,
         CAST(regexp_extract(props, '"k"[ ]*:[ ]*([0-9]+)', 1) AS INTEGER) AS k
  FROM events
), sp AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, d ORDER BY event_id) - 1 AS position,
         row_number() OVER (PARTITION BY user_id, d ORDER BY event_id DESC) AS from_end,
         ms // 1000 + CASE WHEN k % 10 = 0 THEN 7200 WHEN k % 7 = 0 THEN -1800 ELSE 0 END AS unix_time
  FROM ev
), sr AS (
  SELECT *, CASE WHEN seq % 31 = 0 THEN 0 ELSE arrival_ms + (seq % 5 - 2) * 2700000 END AS received_at, {record}
  FROM (SELECT user_id, d, max(event_id) AS seq, max(ms) AS arrival_ms, 'sense-' || user_id AS device_id FROM ev GROUP BY user_id, d)
), sm AS (
  SELECT sr.*, sp.k, sp.event_type, 100 * sp.k * sp.k AS uptime,
         CASE WHEN sp.event_type = 'error' THEN '' ELSE 'ssid-' || (sr.user_id % 5) END AS ssid,
         CASE WHEN sr.user_id % 10 = 0 THEN NULL ELSE 100 + sr.user_id % 7 END AS batch_fw,
         CASE sp.event_type WHEN 'error' THEN NULL WHEN 'signup' THEN '0' ELSE '1.' || (sp.k % 4) END AS top_v,
         CASE WHEN sp.k % 9 = 0 THEN '0' ELSE 'mid' || (200 + sp.k % 5) END AS mid_v
  FROM sr JOIN sp ON sp.event_id = sr.seq
  WHERE sr.bad_payload IS NULL
), pt AS (
  SELECT sm.seq, sm.seq_text, sm.shard_id, sm.device_id, sm.arrival_ms, sm.batch_fw, sp.position, sp.unix_time,
         CASE WHEN sp.event_type = 'view' THEN NULL ELSE sp.k % 4 END AS wave_count,
         CASE WHEN sp.k % 3 = 0 THEN NULL ELSE 300 + 50 * sp.k END AS co2,
         CASE WHEN sp.event_type IN ('click', 'purchase') THEN (890 + 2 * sp.k) * 25600 END AS pa,
         sp.event_type IN ('purchase', 'view') AS has_sensor, sp.k % 9 AS uv,
         CASE sp.event_type WHEN 'view' THEN 1250 * sp.k WHEN 'error' THEN 50000 * sp.k ELSE 0 END AS light,
         CASE WHEN sp.event_type = 'signup' THEN NULL ELSE 20 * sp.k END AS dust,
         100 * sp.k + 50 * (sp.user_id % 3) AS hum, 125 * sp.k - 125 AS tmp, 90 + sp.k % 4 AS point_fw
  FROM sm JOIN sp USING (user_id, d)
), pr AS (
  SELECT *, {record}
  FROM (SELECT user_id, d, max(event_id) AS seq, max(ms) AS arrival_ms FROM ev WHERE event_type IN ('click', 'view') GROUP BY user_id, d)
), pl AS (
  SELECT pr.seq, pr.seq_text, pr.shard_id, pr.arrival_ms, 'pill-' || (2 * sp.user_id + sp.k % 2) AS device_id,
         sp.unix_time * 1000 AS seen_at, sp.event_id AS ord
  FROM pr JOIN sp USING (user_id, d)
  WHERE pr.bad_payload IS NULL AND sp.event_type IN ('click', 'view')
)""".replace("{record}", _RECORD)

_LAST = """, lastm AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY seq DESC) AS rn FROM sm) WHERE rn = 1
)"""

_WIFI = (
    _LAST
    + """, scan AS (
  SELECT lastm.device_id, 'ssid-' || (sp.k % 5) AS entry, -30 - sp.k % 60 AS rssi, sp.position
  FROM lastm JOIN sp USING (user_id, d)
), hit AS (
  SELECT scan.device_id, scan.rssi,
         row_number() OVER (PARTITION BY scan.device_id ORDER BY scan.position) AS rn
  FROM scan JOIN lastm ON lastm.device_id = scan.device_id AND lastm.ssid = scan.entry
), wifi AS (
  SELECT l.device_id, l.ssid, CAST(coalesce(h.rssi, 0) AS INTEGER) AS rssi
  FROM lastm l LEFT JOIN hit h ON h.device_id = l.device_id AND h.rn = 1
)"""
)

_LAST_PILL = """, lastp AS (
  SELECT device_id, seen_at FROM (
    SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY seq DESC, ord DESC) AS rn FROM pl
  ) WHERE rn = 1
)"""

# One firmware per message.
_FW = """, cand AS (
  SELECT seq, seq_text, shard_id, device_id, CAST(coalesce(batch_fw, point_fw) AS VARCHAR) AS version,
         max(unix_time) * 1000 AS ts
  FROM pt GROUP BY ALL
), best AS (
  SELECT *, row_number() OVER (PARTITION BY seq ORDER BY ts DESC, version DESC) AS rn FROM cand
), fw AS (
  SELECT seq, seq_text, shard_id, device_id, mid_v AS middle_version, top_v AS top_version, received_at AS ts
  FROM sm WHERE top_v IS NOT NULL AND top_v <> '0'
  UNION ALL
  SELECT b.seq, b.seq_text, b.shard_id, b.device_id, b.version, '0', b.ts
  FROM best b JOIN sm USING (seq) WHERE b.rn = 1 AND (sm.top_v IS NULL OR sm.top_v = '0')
)"""

_DEVICE_FW = (
    _FW
    + """, fm AS (
  SELECT device_id, middle_version,
         row_number() OVER (PARTITION BY device_id ORDER BY seq DESC) AS rn FROM fw WHERE middle_version <> '0'
), ft AS (
  SELECT device_id, top_version,
         row_number() OVER (PARTITION BY device_id ORDER BY seq DESC) AS rn FROM fw WHERE top_version <> '0'
), fs AS (
  SELECT device_id, ts, row_number() OVER (PARTITION BY device_id ORDER BY seq DESC) AS rn
  FROM fw WHERE middle_version <> '0' OR top_version <> '0'
), devfw AS (
  SELECT fs.device_id, fm.middle_version, ft.top_version, fs.ts AS "timestamp"
  FROM fs LEFT JOIN fm ON fm.device_id = fs.device_id AND fm.rn = 1
  LEFT JOIN ft ON ft.device_id = fs.device_id AND ft.rn = 1
  WHERE fs.rn = 1
)"""
)


def _version_devices(part: str) -> str:
    return f"""
SELECT version, device_id, ts AS "timestamp" FROM (
  SELECT {part} AS version, device_id, ts,
         row_number() OVER (PARTITION BY {part}, device_id ORDER BY seq DESC) AS rn
  FROM fw WHERE {part} <> '0'
) WHERE rn = 1"""


def _last_write(part: str) -> str:
    return f"""
  SELECT version, ts AS "timestamp" FROM (
    SELECT {part} AS version, ts, row_number() OVER (PARTITION BY {part} ORDER BY seq DESC) AS rn FROM fw WHERE {part} <> '0'
  ) WHERE rn = 1"""


_SEEN = f""", seen_middle AS ({_last_write("middle_version")}
), seen_top AS ({_last_write("top_version")}
)"""

_HOURS_SENSE = """, hs AS (SELECT DISTINCT arrival_ms // 3600000 AS h, device_id FROM sm)"""
_HOURS_PILL = """, hp AS (SELECT DISTINCT arrival_ms // 3600000 AS h, device_id FROM pl)"""


def _hourly(table: str) -> str:
    return f"""
SELECT strftime(make_timestamp(h * 3600000000), '%Y_%m_%d_%H_00') AS hour_key, device_id,
       h * 3600 + 172800 AS expire_at
FROM {table}"""


# One row per broken rule.
_BAD = """, bad AS (
  SELECT *, 'low-co2' AS meter, 'co2' AS sensor, co2 AS val FROM pt WHERE co2 < 400
  UNION ALL SELECT *, 'high-co2', 'co2', co2 FROM pt WHERE co2 > 3500
  UNION ALL SELECT *, 'low-pa', 'pa', pa FROM pt WHERE pa < 900 * 256 * 100
  UNION ALL SELECT *, 'high-pa', 'pa', pa FROM pt WHERE pa > 1086 * 256 * 100
  UNION ALL SELECT *, 'high-uv', 'uv', uv FROM pt WHERE has_sensor AND uv > 6
  UNION ALL SELECT *, 'high-dust', 'dust', dust FROM pt WHERE dust > 250 * 6
  UNION ALL SELECT *, 'high-lux', 'onefivelux', light FROM pt WHERE has_sensor AND light > 100000
  UNION ALL SELECT *, 'high-lux', 'onelux', light FROM pt WHERE NOT has_sensor AND light > 4194304
  UNION ALL SELECT *, 'low-hum', 'hum', hum FROM pt WHERE hum < 100
  UNION ALL SELECT *, 'high-hum', 'hum', hum FROM pt WHERE hum > 9900
  UNION ALL SELECT *, 'low-tmp', 'tmp', tmp FROM pt WHERE tmp < 0
  UNION ALL SELECT *, 'high-tmp', 'tmp', tmp FROM pt WHERE tmp > 10000
)"""

_LOW = """, low AS (
  SELECT shard_id, arrival_ms // 3600000 * 3600000 AS hour_start, device_id, min(arrival_ms) AS first_ms
  FROM sm WHERE uptime <= 3600 GROUP BY ALL
)"""

# Every metered event as (metric, time, amount).
_METERED = (
    _BAD
    + _LOW
    + """, metered AS (
  SELECT 'sense.messages-processed' AS metric, arrival_ms AS t_ms, 1 AS amount FROM sr
  UNION ALL SELECT 'pill.messages-processed', arrival_ms, 1 FROM pr
  UNION ALL SELECT 'sense.low-uptime', first_ms, 1 FROM low
  UNION ALL SELECT 'sense.wave-counts', arrival_ms, wave_count FROM pt WHERE wave_count > 0
  UNION ALL SELECT 'sense.' || meter, arrival_ms, 1 FROM bad
)"""
)


def _track(stream: str, times: str) -> str:
    """The sampling rule record by record, in arrival order."""
    return f""", seqd AS (
  SELECT shard_id, seq, seq_text, ts, row_number() OVER (PARTITION BY shard_id ORDER BY seq, ord) AS rn
  FROM ({times})
), walk AS (
  SELECT shard_id, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS last_kept, '' AS seq_text, FALSE AS kept
  FROM (SELECT DISTINCT shard_id FROM seqd)
  UNION ALL
  SELECT s.shard_id, s.rn, CASE WHEN s.ts > w.last_kept + 300000 THEN s.ts ELSE w.last_kept END, s.seq_text,
         s.ts > w.last_kept + 300000
  FROM walk w JOIN seqd s ON s.shard_id = w.shard_id AND s.rn = w.rn + 1
)
SELECT '{stream}:' || shard_id AS stream_shard_id,
       strftime(make_timestamp(last_kept * 1000), '%Y-%m-%d %H:%M:%S') || '+0000' AS created_at,
       seq_text AS checkpoint
FROM walk WHERE kept"""


_SENSE_TIMES = """SELECT shard_id, seq, seq_text, position AS ord, unix_time * 1000 AS ts FROM pt
        WHERE unix_time * 1000 < arrival_ms + 3600000"""
_PILL_TIMES = """SELECT shard_id, seq, seq_text, ord, seen_at AS ts FROM pl WHERE seen_at < arrival_ms + 3600000"""

_UPTIME_STATS = """
       round(avg(days), 6) AS mean_days, round(stddev_samp(days), 6) AS stddev_days,
       round(quantile_cont(days, 0.5), 6) AS p50, round(quantile_cont(days, 0.75), 6) AS p75,
       round(quantile_cont(days, 0.95), 6) AS p95, round(quantile_cont(days, 0.98), 6) AS p98,
       round(quantile_cont(days, 0.99), 6) AS p99, round(quantile_cont(days, 0.999), 6) AS p999"""

_REPORT_STATS = [
    ("min", "min(days)"),
    ("max", "max(days)"),
    ("mean", "round(avg(days), 6)"),
    *[
        (name, f"round(quantile_cont(days, {q}), 6)")
        for name, q in [("p50", 0.5), ("p75", 0.75), ("p95", 0.95), ("p98", 0.98), ("p99", 0.99), ("p999", 0.999)]
    ],
]

_REPORT = (
    _METERED
    + """, iv AS (
  SELECT metric, t_ms // 30000 * 30000 AS window_start, sum(amount) AS events FROM metered
  WHERE regexp_matches(metric, 'messages-processed') OR regexp_matches(metric, 'wave')
     OR regexp_matches(metric, '^sense[.]low-')
  GROUP BY ALL
), ud AS (SELECT arrival_ms // 30000 * 30000 AS window_start, CAST(uptime // 86400 AS DOUBLE) AS days FROM sm)
SELECT metric || '.count' AS metric, window_start, CAST(events AS DOUBLE) AS value FROM iv
UNION ALL SELECT metric || '.rate', window_start, round(events / 30.0, 6) FROM iv"""
    + "".join(
        f"\nUNION ALL SELECT 'sense.uptime-days.{name}', window_start, CAST({stat} AS DOUBLE) FROM ud GROUP BY window_start"
        for name, stat in _REPORT_STATS
    )
)

_EXPORT = (
    _WIFI
    + _LAST_PILL
    + _DEVICE_FW
    + _SEEN
    + _HOURS_SENSE
    + _HOURS_PILL
    + f""", hsk AS ({_hourly("hs")}), hpk AS ({_hourly("hp")}),
mdev AS ({_version_devices("middle_version")}), tdev AS ({_version_devices("top_version")})
SELECT 'active_senses' AS "key", device_id AS field, CAST(received_at AS VARCHAR) AS value FROM lastm
UNION ALL SELECT 'sense_uptimes', device_id, CAST(uptime AS VARCHAR) FROM lastm
UNION ALL SELECT 'wifi_info', device_id, ssid || ' : ' || rssi FROM wifi
UNION ALL SELECT 'device_id:' || device_id, 'middle_version', middle_version FROM devfw WHERE middle_version IS NOT NULL
UNION ALL SELECT 'device_id:' || device_id, 'top_version', top_version FROM devfw WHERE top_version IS NOT NULL
UNION ALL SELECT 'device_id:' || device_id, 'timestamp', CAST("timestamp" AS VARCHAR) FROM devfw
UNION ALL SELECT 'firmwares_seen', version, CAST("timestamp" AS VARCHAR) FROM seen_middle
UNION ALL SELECT 'top_firmwares_seen', version, CAST("timestamp" AS VARCHAR) FROM seen_top
UNION ALL SELECT 'middle:' || version, device_id, CAST("timestamp" AS VARCHAR) FROM mdev
UNION ALL SELECT 'top:' || version, device_id, CAST("timestamp" AS VARCHAR) FROM tdev
UNION ALL SELECT 'active_pills', device_id, CAST(seen_at AS VARCHAR) FROM lastp
UNION ALL SELECT 'hourly_active_sense_' || hour_key, device_id, NULL FROM hsk
UNION ALL SELECT 'hourly_active_pill_' || hour_key, device_id, NULL FROM hpk"""
)

_NOW = "(SELECT max(epoch_us(ts) // 1000) // 1000 FROM events)"

_BODIES: dict[str, str] = {
    "sense_dead_letters": """
SELECT shard_id, seq_text AS sequence_number, arrival_ms, bad_payload AS payload FROM sr WHERE bad_payload IS NOT NULL""",
    "pill_dead_letters": """
SELECT shard_id, seq_text AS sequence_number, arrival_ms, bad_payload AS payload FROM pr WHERE bad_payload IS NOT NULL""",
    "active_senses": _LAST + " SELECT device_id, received_at FROM lastm",
    "active_pills": _LAST_PILL + " SELECT device_id, seen_at FROM lastp",
    "sense_uptimes": _LAST + " SELECT device_id, CAST(uptime AS INTEGER) AS uptime_seconds FROM lastm",
    "wifi_info": _WIFI
    + """
SELECT device_id, ssid, rssi, ssid || ' : ' || rssi AS wifi_text, ssid <> '' AND rssi <> 0 AS known FROM wifi""",
    "hourly_active_sense": _HOURS_SENSE + _hourly("hs"),
    "hourly_active_pill": _HOURS_PILL + _hourly("hp"),
    "hourly_active_sense_live": _HOURS_SENSE + _hourly("hs") + f" WHERE h * 3600 + 172800 > {_NOW}",
    "hourly_active_pill_live": _HOURS_PILL + _hourly("hp") + f" WHERE h * 3600 + 172800 > {_NOW}",
    "sense_firmware": _FW
    + """
SELECT shard_id, seq_text AS sequence_number, device_id, middle_version, top_version, ts AS "timestamp"
FROM fw""",
    "missing_top_firmware": """
SELECT shard_id, seq_text AS sequence_number, device_id FROM sm WHERE coalesce(top_v, '0') = '0'""",
    "device_firmware": _DEVICE_FW + " SELECT * FROM devfw",
    "firmwares_seen": _FW + _SEEN
    + """
SELECT * FROM seen_middle""",
    "top_firmwares_seen": _FW + _SEEN
    + """
SELECT * FROM seen_top""",
    "middle_firmware_devices": _FW + _version_devices("middle_version"),
    "top_firmware_devices": _FW + _version_devices("top_version"),
    "data_quality_counts": _BAD
    + """
SELECT m.meter, count(bad.seq) AS events
FROM (VALUES ('low-co2'), ('high-co2'), ('low-pa'), ('high-pa'), ('high-uv'), ('high-dust'), ('high-lux'),
             ('low-hum'), ('high-hum'), ('low-tmp'), ('high-tmp'), ('high-db')) m(meter)
LEFT JOIN bad ON bad.meter = m.meter GROUP BY m.meter""",
    "bad_sensor_events": _BAD
    + """
SELECT shard_id, seq_text AS sequence_number, CAST(position AS INTEGER) AS position, device_id,
       CAST(coalesce(batch_fw, 0) AS INTEGER) AS fw_version, meter, sensor, CAST(val AS INTEGER) AS value
FROM bad""",
    "sense_messages_processed": " SELECT count(*) AS messages FROM sr",
    "pill_messages_processed": " SELECT count(*) AS messages FROM pr",
    "wave_counts": " SELECT CAST(coalesce(sum(wave_count), 0) AS BIGINT) AS wave_count FROM pt",
    "low_uptime_devices": """
SELECT shard_id, arrival_ms // 3600000 * 3600000 AS hour_start, count(DISTINCT device_id) AS devices
FROM sm WHERE uptime <= 3600 GROUP BY ALL""",
    "low_uptime_devices_approx": """
SELECT s.shard_id, w.period_hours, arrival_ms // (period_hours * 3600000) * (period_hours * 3600000) AS period_start,
       count(DISTINCT device_id) AS devices
FROM (SELECT shard_id, device_id, arrival_ms FROM sm WHERE uptime <= 3600
      UNION ALL SELECT 'all', device_id, arrival_ms FROM sm WHERE uptime <= 3600) s,
     (VALUES (1::BIGINT), (24), (168)) w(period_hours) GROUP BY ALL""",
    "low_uptime_devices_chained": """, chain AS (
  SELECT shard_id, min(arrival_ms) AS s FROM sr GROUP BY shard_id
  UNION ALL
  SELECT shard_id, s FROM (
    SELECT c.shard_id, (SELECT min(a.arrival_ms) FROM sr a WHERE a.shard_id = c.shard_id AND a.arrival_ms > c.s + 3600000) AS s FROM chain c
  ) WHERE s IS NOT NULL
)
SELECT c.shard_id, c.s AS period_start, count(DISTINCT sm.device_id) AS devices
FROM chain c JOIN sm ON sm.shard_id = c.shard_id AND sm.arrival_ms BETWEEN c.s AND c.s + 3600000
WHERE sm.uptime <= 3600 GROUP BY ALL""",
    "uptime_days": f"""
SELECT count(*) AS messages, CAST(min(days) AS INTEGER) AS min_days, CAST(max(days) AS INTEGER) AS max_days,{_UPTIME_STATS}
FROM (SELECT CAST(uptime // 86400 AS DOUBLE) AS days FROM sm)""",
    "meter_rates": _METERED
    + """, placed AS (
  SELECT metric, m, t_ms // (m * 60000) * (m * 60000) AS window_start, amount
  FROM metered, (VALUES (1), (5), (15)) w(m)
)
SELECT metric, CAST(m AS INTEGER) AS window_minutes, window_start,
       CAST(sum(amount) AS BIGINT) AS events, round(sum(amount) / (m * 60.0), 6) AS rate
FROM placed GROUP BY metric, m, window_start""",
    "metrics_report": _REPORT,
    "sense_checkpoint_track": _track("sense_sensors_data", _SENSE_TIMES),
    "pill_checkpoint_track": _track("batch_pill_data", _PILL_TIMES),
    "state_export": _EXPORT,
}

ORACLES: dict[str, str] = {name: _BASE + body for name, body in _BODIES.items()}
ORACLES |= {f"{name}_stream": ORACLES[name] for name in STREAMS}
