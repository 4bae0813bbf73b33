"""Index from event time to stream position, sampled per shard.

The rule is a fold over the arrival order of one shard: keep a reading when its time is more than
five minutes after the last kept one and less than an hour ahead of the clock. Two exact
reductions run before the fold, both spread over all executors:

1. Per (shard, time) only the first arrival can be kept. This aggregate has map-side partials and
   leaves at most one row per second of event time in a shard, however many records it holds.
2. A kept reading is a strict running maximum of the arrival order, in its shard and therefore in
   every subset. So within (shard, day) a reading goes when a later time arrived before it. A group
   holds at most one row per second of the day.

What is left of a shard is bounded by the seconds of event time it spans, not by its traffic. The
fold streams it in Arrow batches and keeps one number per shard.

Both reductions are associative and idempotent, so what is left of a shard, its *staircase* (times that rise
with their arrival), is also the state of a stream: staircases of batches merge in any order, and the fold runs on read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.functions import clock
from fleetmeter.functions.arrival import arrival

# Spacing of the index and how far ahead of the clock a reading may be.
TRACK_PERIOD_MS = 5 * clock.MINUTE_MS
MAX_AHEAD_MS = 60 * clock.MINUTE_MS

_KEPT = "shard_id string, ts long, sequence_number string"


def sense_times(messages: DataFrame, clock_column: str = "arrival_ms") -> DataFrame:
    return messages.select(
        "shard_id",
        "sequence_number",
        F.col(clock_column).alias("clock_ms"),
        F.posexplode("points.unix_time").alias("position", "unix_time"),
    ).select("shard_id", "sequence_number", "position", "clock_ms", clock.seconds_to_ms(F.col("unix_time")).alias("ts"))


def pill_times(readings: DataFrame) -> DataFrame:
    return readings.select(
        "shard_id", "sequence_number", "position", F.col("arrival_ms").alias("clock_ms"), F.col("seen_at").alias("ts")
    )


def candidates(times: DataFrame) -> DataFrame:
    """Readings that can be kept: (shard_id, ts, arrival)."""
    near = times.where(F.col("ts") < F.col("clock_ms") + MAX_AHEAD_MS).where(F.col("ts") > TRACK_PERIOD_MS)
    return reduce_candidates(near.select("shard_id", "ts", arrival("position").alias("arrival")))


def reduce_candidates(rows: DataFrame) -> DataFrame:
    """Associative and idempotent. A reading that an earlier arrival of a later time rules out stays ruled out: that
    arrival is in the state, or another that rules out both.
    """
    first = rows.groupBy("shard_id", "ts").agg(F.min("arrival").alias("arrival"))
    day = F.call_function("div", F.col("ts"), F.lit(clock.DAY_MS))
    later = (
        Window.partitionBy("shard_id", day)
        .orderBy(F.col("ts").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        first.withColumn("earliest_later", F.min("arrival").over(later))
        .where(F.col("earliest_later").isNull() | (F.col("arrival") < F.col("earliest_later")))
        .select("shard_id", "ts", "arrival")
    )


def _thinner(period_ms: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The fold, over rows sorted by (shard, arrival); a shard may go on over several batches.

    It is a closure so that Spark ships its code to executors that lack this package.
    """

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, last = None, 0
        for batch in batches:
            shards = batch.column("shard_id").to_numpy(zero_copy_only=False)
            times = batch.column("ts").to_numpy(zero_copy_only=False)
            bounds = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1], True]) if len(times) else []
            kept: list[int] = []
            for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                if shards[start] != shard:
                    shard, last = shards[start], 0
                # The next kept reading is where the running maximum first passes last + period.
                highest = np.maximum.accumulate(times[start:end])
                at = int(np.searchsorted(highest, last + period_ms, side="right"))
                while at < end - start:
                    kept.append(start + at)
                    last = int(highest[at])
                    at = int(np.searchsorted(highest, last + period_ms, side="right"))
            if kept:
                yield batch.select(["shard_id", "ts", "sequence_number"]).take(pa.array(kept))

    return thin


def thinned(staircase: DataFrame) -> DataFrame:
    """Kept readings of reduced candidates as (shard_id, ts, sequence_number)."""
    ordered = staircase.repartition("shard_id").sortWithinPartitions("shard_id", "arrival")
    return ordered.select("shard_id", "ts", F.col("arrival.number").alias("sequence_number")).mapInArrow(
        _thinner(TRACK_PERIOD_MS), _KEPT
    )


def kept_positions(times: DataFrame) -> DataFrame:
    """Kept readings as (shard_id, ts, sequence_number)."""
    return thinned(candidates(times))


def checkpoint_track(kept: DataFrame, stream: str) -> DataFrame:
    """Rows of the position index: (stream:shard, event time text) -> sequence number."""
    return kept.select(
        F.concat_ws(":", F.lit(stream), F.col("shard_id")).alias("stream_shard_id"),
        clock.created_at(F.col("ts")).alias("created_at"),
        F.col("sequence_number").alias("checkpoint"),
    )
