"""The metrics report of a stream: every interval is reported once, when the stream's clock has passed it.

The clock is the arrival of the records, less ``grace`` for records that come late, and never ahead of the time of the
job. Each task adds up its records per interval first. A processor for each (day, group of devices) holds the intervals that are open
and the low-uptime devices of each hour. When its timer fires, the sums of the intervals that have ended go out and leave the state.

A record that comes after its interval was reported counts in the earliest interval that is still open, as a
meter counts what it sees: nothing is dropped and nothing is reported twice. A heartbeat, a record without a shard, moves the
clock and counts nowhere, so the last intervals close although nothing follows. A batch that is repeated overwrites its own rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from fleetmeter import schemas
from fleetmeter.functions import clock, rules
from fleetmeter.operators import metrics
from fleetmeter.sources import decode
from fleetmeter.streaming import changes
from fleetmeter.streaming.state import with_rocksdb

#: Processors that share the devices of a day.
GROUPS = 32
GRACE = "1 minute"
#: How long the low-uptime devices of a day are remembered after it.
REMEMBERED_MS = clock.HOURLY_SET_TTL_SECONDS * 1000

_LOW = "low"
_DAYS = "days:"
_SENSE_LOW = "sense.low-uptime"
_COUNTED = "day long, part int, kind string, window_start long, name string, amount long"


def _entry(kind: str, name: Column, amount: Column) -> Column:
    """A heartbeat has no amounts. It must not be filtered out: filters move below the watermark, which then misses it."""
    amount = F.when(F.col("shard_id").isNotNull(), amount.cast("long"))
    return F.struct(F.lit(kind).alias("kind"), name.alias("name"), amount.alias("amount"))


def _breaking(points: Column, rule: rules.Rule) -> Column:
    return F.size(F.filter(points, lambda point: rules.breaks(rule, point)))


def _sense_entries(names: Iterable[str]) -> Column:
    """What a parsed record adds to each meter, without exploding its points; low-uptime devices with their arrival."""
    good = ~F.col("malformed")
    points = F.when(good, F.col("message.data.data"))
    uptime = F.coalesce("message.uptime_in_second", F.lit(0))
    device = F.concat_ws("|", "shard_id", F.coalesce("message.data.device_id", F.lit("")))
    amounts: dict[str, Column] = {
        "messages-processed": F.lit(1),
        "wave-counts": F.aggregate(points, F.lit(0).cast("long"), lambda n, p: n + F.coalesce(p["wave_count"], F.lit(0))),
    }
    for meter in rules.METERS:
        broken = [_breaking(points, rule) for rule in rules.RULES if rule.meter == meter]
        amounts[meter] = sum(broken[1:], broken[0]) if broken else F.lit(0)
    names = set(names)
    entries = [_entry("sum", F.lit(f"sense.{n}"), a) for n, a in amounts.items() if f"sense.{n}" in names]
    if metrics.UPTIME_HISTOGRAM in names:
        days = F.concat(F.lit(_DAYS), clock.whole_days(uptime).cast("string"))
        entries.append(_entry("sum", days, F.when(good, 1)))
    if _SENSE_LOW in names:
        entries.append(_entry(_LOW, device, F.when(good & (uptime <= metrics.LOW_UPTIME_SECONDS), F.col("arrival_ms"))))
    return F.array(*(entries or [_entry("sum", F.lit(""), F.lit(0))]))


def _pill_entries(names: Iterable[str]) -> Column:
    name = "pill.messages-processed"
    return F.array(_entry("sum", F.lit(name), F.lit(int(name in set(names)))))


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key and name of each batch of rows: sums, and of low-uptime devices the first arrival."""
    keys = ["day", "part", "kind", "hour", "window_start", "name"]
    for batch in batches:
        whole = pa.table({n: batch.column(n) for n in (*keys, "amount")}).group_by(keys).aggregate([("amount", "sum"), ("amount", "min")])
        low = pa.compute.equal(whole["kind"], _LOW)
        amount = pa.compute.if_else(low, whole["amount_min"], whole["amount_sum"])
        names = ["day", "part", "kind", "window_start", "name"]
        out = pa.table({**{k: whole[k] for k in names}, "amount": amount.cast(pa.int64())}).combine_chunks()
        yield from out.to_batches()


class IntervalProcessor(StatefulProcessor):
    """State of a (day, group): the sums of its open intervals by name; of each hour's low-uptime devices the first arrival
    and the interval that it was counted in. One timer at a time, for the interval that ends next."""

    def __init__(self, width_ms: int):
        self.width = width_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "windows array<long>, names array<string>, amounts array<long>")
        self.lows = handle.getMapState("lows", "hour long, device string", "first_ms long, window_start long")

    def _sums(self) -> Counter:
        held = self.open.get()
        return Counter({(w, n): a for w, n, a in zip(*held, strict=True)}) if held else Counter()

    def _keep(self, sums: Counter) -> None:
        if not sums:
            self.open.clear()
            return
        windows, names = zip(*sums, strict=True)
        self.open.update((list(windows), list(names), list(sums.values())))
        self.handle.registerTimer(min(windows) + self.width)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        earliest = timerValues.getCurrentWatermarkInMs() // self.width * self.width
        sums, low = self._sums(), False
        for r in rows:
            if r.kind != _LOW:
                sums[max(r.window_start, earliest), r.name] += r.amount
                continue
            low, device = True, (r.amount // clock.HOUR_MS, r.name)
            window = max(r.amount // self.width * self.width, earliest)
            known = self.lows.getValue(device) if self.lows.containsKey(device) else None
            if known is None:
                sums[window, _SENSE_LOW] += 1
                self.lows.updateValue(device, (r.amount, window))
            elif r.amount < known[0] and known[1] >= earliest:  # it came earlier, and that is not reported yet
                sums[known[1], _SENSE_LOW] -= 1
                sums[window, _SENSE_LOW] += 1
                self.lows.updateValue(device, (r.amount, window))
        self._keep(sums)
        if low:
            self.handle.registerTimer(key[0] + clock.DAY_MS + REMEMBERED_MS)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, sums = timerValues.getCurrentWatermarkInMs(), self._sums()
        due = {k: n for k, n in sums.items() if k[0] + self.width <= now}
        for (window, name), amount in due.items():
            if amount:
                yield Row(window_start=window, name=name, events=amount)
        if due:
            self._keep(Counter({k: n for k, n in sums.items() if k not in due}))
        if expiredTimerInfo.getExpiryTimeInMs() >= key[0] + clock.DAY_MS + REMEMBERED_MS:
            self.lows.clear()

    def close(self) -> None:
        pass


def _closed(raw: DataFrame, message, entries: Column, who: Column, interval_seconds: int, grace: str) -> DataFrame:
    """window_start, name and events of the intervals that a batch closes."""
    width = interval_seconds * 1000
    arrived = F.least(F.timestamp_millis("arrival_ms"), F.current_timestamp())
    rows = decode.parse(raw, message).withColumn("arrived", arrived).withWatermark("arrived", grace)
    # Without the watermarked column nothing below takes a late row for one to be dropped.
    rows = rows.select(
        clock.floor_ms(F.col("arrival_ms"), clock.DAY_MS).alias("day"),
        clock.floor_ms(F.col("arrival_ms"), clock.HOUR_MS).alias("hour"),
        F.pmod(F.xxhash64("shard_id", who), F.lit(GROUPS)).cast("int").alias("part"),
        clock.floor_ms(F.col("arrival_ms"), width).alias("window_start"),
        F.inline(entries),
    )
    rows = rows.where("amount > 0").select("day", "part", "kind", "hour", "window_start", "name", "amount")
    counted = with_rocksdb(rows).mapInArrow(_added_up, _COUNTED)
    return counted.groupBy("day", "part").transformWithState(
        IntervalProcessor(width), "window_start long, name string, events long", "Append", "EventTime"
    )


def _start(closed: DataFrame, path: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        closed.writeStream.outputMode("append")
        .foreachBatch(lambda batch, batch_id: changes.write(batch, path, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def start_sense(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    include: Iterable[str] | None = None,
    interval_seconds: int = 30,
    grace: str = GRACE,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the closed intervals of the sense meters below ``path``."""
    metrics.check_interval(interval_seconds)
    entries = _sense_entries(metrics.included(metrics.REPORTED, include))
    who = F.coalesce("message.data.device_id", F.col("sequence_number"))
    return _start(_closed(raw, schemas.SENSE_MESSAGE, entries, who, interval_seconds, grace), path, checkpoint, trigger)


def start_pill(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    include: Iterable[str] | None = None,
    interval_seconds: int = 30,
    grace: str = GRACE,
    trigger: dict | None = None,
) -> StreamingQuery:
    metrics.check_interval(interval_seconds)
    entries = _pill_entries(metrics.included(metrics.REPORTED, include))
    who = F.col("sequence_number")
    return _start(_closed(raw, schemas.PILL_MESSAGE, entries, who, interval_seconds, grace), path, checkpoint, trigger)


def read(spark, paths: Iterable[str], interval_seconds: int = 30) -> DataFrame:
    """The report (metric, window_start, value) of the intervals that have closed, from both streams' folders."""
    rows = None
    for path in paths:
        some = changes.read(spark, path, lambda closed: closed.groupBy("window_start", "name").agg(F.sum("events").alias("events")))
        rows = some if rows is None else rows.unionByName(some)
    of_days = F.col("name").startswith(_DAYS)
    events = rows.where(~of_days).select(F.col("name").alias("metric"), "window_start", "events")
    days = F.substring("name", len(_DAYS) + 1, 20).cast("int").alias("days")
    return metrics.reported(events, rows.where(of_days).select("window_start", days, F.col("events").alias("n")), interval_seconds)
