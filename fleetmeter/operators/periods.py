"""Counting periods that chain from the first arrival of a shard, without a grid.

A period begins with an arrival; the next one begins with the first arrival more than an hour after that. Every arrival
therefore points to one later arrival, and the beginnings are what is reached from a shard's first arrival. They are found by pointer
doubling: in round k all arrivals know where 2**k steps lead, and the beginnings known so far are moved by as much, so n
periods take log2(n) rounds, whichever shard they are in, and no shard is walked by one task.

Pointers come from windows of one hour of one shard: the target lies in the hour after the arrival's own, or it is the first arrival of the
next hour that has any. Arrivals that no pointer leads to are dropped before the rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.operators.metrics import LOW_UPTIME_SECONDS
from fleetmeter.sources.tables import stored

# Fixed value: a period ends an hour after its beginning, inclusive.
PERIOD_MS = 3_600_000


def _pointers(times: DataFrame) -> DataFrame:
    """(shard_id, at, to): for every arrival time, the first one more than a period later."""
    hour = F.call_function("div", F.col("at"), F.lit(PERIOD_MS)).alias("hour")
    known = times.select("shard_id", hour, "at", F.col("at").alias("time"), F.lit(None).cast("long").alias("source"))
    asked = times.select(
        "shard_id", (hour + 1).alias("hour"), (F.col("at") + PERIOD_MS).alias("at"), F.lit(None).cast("long").alias("time"), F.col("at").alias("source")
    )
    # From late to early, and at one time the questions first: what is already there lies strictly later.
    seen = Window.partitionBy("shard_id", "hour").orderBy(F.desc("at"), F.col("time").asc_nulls_first())
    within = known.unionByName(asked).withColumn("to", F.min("time").over(seen)).where(F.col("source").isNotNull())
    hours = times.groupBy("shard_id", hour).agg(F.min("at").alias("first"))
    starts = hours.unionByName(
        times.select("shard_id", (hour + 1).alias("hour")).distinct().withColumn("first", F.lit(None).cast("long")), True
    )
    starts = starts.groupBy("shard_id", "hour").agg(F.min("first").alias("first"))
    later = Window.partitionBy("shard_id").orderBy(F.desc("hour")).rowsBetween(Window.unboundedPreceding, -1)
    beyond = starts.select("shard_id", "hour", F.min("first").over(later).alias("beyond"))
    found = within.join(beyond, ["shard_id", "hour"]).select("shard_id", F.col("source").alias("at"), F.coalesce("to", "beyond").alias("to"))
    return found.where(F.col("to").isNotNull())


def beginnings(arrivals: DataFrame) -> DataFrame:
    """(shard_id, period_start) of every period; ``arrivals`` has shard_id and arrival_ms."""
    times = stored(arrivals.select("shard_id", F.col("arrival_ms").alias("at")).distinct(), "period-times")
    first = times.groupBy("shard_id").agg(F.min("at").alias("at"))
    jumps = stored(_pointers(times), "period-jumps")
    reached = first.unionByName(jumps.select("shard_id", F.col("to").alias("at"))).distinct()
    jumps = stored(jumps.join(reached, ["shard_id", "at"], "left_semi"), "period-jumps")
    found = stored(first, "period-starts")
    while not jumps.isEmpty():
        moved = found.join(jumps, ["shard_id", "at"]).select("shard_id", F.col("to").alias("at"))
        found = stored(found.unionByName(moved).distinct(), "period-starts")
        onward = jumps.select("shard_id", F.col("at").alias("to"), F.col("to").alias("further"))
        jumps = stored(jumps.join(onward, ["shard_id", "to"]).select("shard_id", "at", F.col("further").alias("to")), "period-jumps")
    return found.select("shard_id", F.col("at").alias("period_start"))


def low_uptime_devices_chained(arrivals: DataFrame, messages: DataFrame) -> DataFrame:
    """Distinct low-uptime devices of each period. All arrivals, malformed records too, make the periods.

    An arrival is at most a period after its beginning, so that lies in the arrival's own hour or in the one before.
    """
    hour = F.call_function("div", F.col("arrival_ms"), F.lit(PERIOD_MS))
    low = messages.where(F.col("uptime_seconds") <= LOW_UPTIME_SECONDS)
    low = low.select("shard_id", "device_id", "arrival_ms", hour.alias("hour")).distinct()
    own = F.call_function("div", F.col("period_start"), F.lit(PERIOD_MS))
    starts = beginnings(arrivals).select("shard_id", "period_start", F.explode(F.array(own, own + 1)).alias("hour"))
    met = low.join(starts, ["shard_id", "hour"]).where(F.col("arrival_ms").between(F.col("period_start"), F.col("period_start") + PERIOD_MS))
    return met.groupBy("shard_id", "period_start").agg(F.countDistinct("device_id").alias("devices"))
