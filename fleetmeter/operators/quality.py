"""Sensor data-quality: counts per meter and the log of bad readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions import rules
from fleetmeter.sources.decode import sense_points


def meter_columns(point: str = "point") -> dict[str, Column]:
    """One conditional count per meter, over rows that hold a data point."""
    columns: dict[str, Column] = {}
    for meter in rules.METERS:
        parts = [F.count_if(rules.breaks(r, point)) for r in rules.RULES if r.meter == meter]
        columns[meter] = sum(parts[1:], parts[0]) if parts else F.lit(0).cast("long")
    return columns


def unpivot(wide: DataFrame, keys: list[str], names: list[str], name: str, value: str) -> DataFrame:
    return wide.unpivot(keys, [F.col(f"`{n}`") for n in names], name, value)


def data_quality_counts(messages: DataFrame) -> DataFrame:
    """All meters in one pass over the points; one row per meter, zeros included."""
    columns = meter_columns()
    wide = sense_points(messages).agg(*[c.alias(m) for m, c in columns.items()])
    return unpivot(wide, [], list(columns), "meter", "events")


def bad_sensor_events(messages: DataFrame) -> DataFrame:
    """One row per broken rule; the logged firmware is the batch-level one, 0 when absent."""
    hits = F.array(
        *[
            F.when(
                rules.breaks(r),
                F.struct(
                    F.lit(r.meter).alias("meter"),
                    F.lit(r.label).alias("sensor"),
                    rules.value(r).alias("value"),
                ),
            )
            for r in rules.RULES
        ]
    )
    points = sense_points(messages, "shard_id", "sequence_number", "device_id", "batch_firmware")
    return points.select(
        "shard_id",
        "sequence_number",
        "position",
        "device_id",
        F.coalesce("batch_firmware", F.lit(0)).alias("fw_version"),
        F.inline(F.array_compact(hits)),
    )
