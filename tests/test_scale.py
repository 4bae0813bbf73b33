"""Plans and groups that must not grow with the data, checked on skewed input."""

import random

import pytest
from helpers import message, point, raw, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fleetmeter import schemas
from fleetmeter.operators import positions
from fleetmeter.sources import decode, derived

EVENTS = 250_000


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """One user holds a third of all events, all on one day."""
    path = str(tmp_path_factory.mktemp("skewed"))
    spark.range(EVENTS).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(0, 0, 0, id / 10)").alias("ts"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997).cast("long").alias("user_id"),
        F.element_at(F.array(*[F.lit(t) for t in ("view", "click", "error", "signup")]), (F.col("id") % 4 + 1).cast("int")).alias(
            "event_type"
        ),
        F.lit(1.0).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 100).alias("props"),
    ).coalesce(1).write.parquet(f"{path}/events.parquet")
    return path


def test_a_message_is_one_user_and_day(spark, skewed):
    """Also for the user with a third of all events."""
    source = derived.events(spark, skewed)
    assert derived.sense_raw(spark, skewed).count() == source.select("user_id", "day").distinct().count()


def test_skewed_input_equals_sql(spark, skewed):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{skewed}/events.parquet/*.parquet'")
    for name in ("active_senses", "active_pills", "device_firmware", "data_quality_counts", "uptime_days", "meter_rates"):
        result = entry.queries()[name](spark, skewed)
        columns = sorted(result.columns)
        sql = entry.oracle_sql()[name]
        order = [con.sql(sql).columns.index(c) for c in columns]
        expected = [tuple(r[i] for i in order) for r in con.execute(sql).fetchall()]
        assert rows(result, *columns) == sorted(expected, key=lambda r: [(v is None, str(v)) for v in r]), name


def test_fold_input_is_bounded_by_event_time(spark):
    """Ten thousand readings of a shard within 200 seconds leave at most 200 candidates."""
    rng = random.Random(1)
    payloads = [
        message("d", 1_700_000_000_000, [point(1_699_999_000 + rng.randrange(200)) for _ in range(100)])
        for _ in range(100)
    ]
    messages = decode.decode_sense(raw(spark, *payloads))
    left = positions.candidates(positions.sense_times(messages)).count()
    assert 0 < left <= 200


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not n.endswith("_stream")))
def test_plan_has_no_cross_join_and_reads_needed_columns(spark, name, capsys):
    from conftest import SF_DIR

    entry.queries()[name](spark, SF_DIR).explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "value:double" not in plan


def test_aggregates_combine_before_the_shuffle(spark, capsys):
    from fleetmeter.operators import devices, metrics

    parsed = decode.parse(raw(spark, message("d")), schemas.SENSE_MESSAGE)
    messages = decode.sense_messages(parsed)
    for table in (devices.sense_state(messages), metrics.low_uptime_first(messages), metrics.sense_meters(parsed, 60_000)):
        capsys.readouterr()
        table.explain()
        plan = capsys.readouterr().out
        below = plan[plan.index("Exchange") :]
        assert "partial_" in below
