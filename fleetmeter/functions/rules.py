"""Threshold rules of the sensor data-quality meters, as data."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rule(NamedTuple):
    meter: str
    label: str  # name of the sensor in the log of bad readings
    field: str  # field of the data point that is compared
    compare: str  # "<" or ">", both strict
    threshold: int


# Meters, labels and thresholds.
RULES = (
    Rule("low-co2", "co2", "co2", "<", 400),
    Rule("high-co2", "co2", "co2", ">", 3500),
    Rule("low-pa", "pa", "pressure", "<", 23_040_000),
    Rule("high-pa", "pa", "pressure", ">", 27_801_600),
    Rule("high-uv", "uv", "light_sensor.uv_count", ">", 6),
    Rule("high-dust", "dust", "dust", ">", 1500),
    Rule("high-lux", "onefivelux", "light", ">", 100_000),
    Rule("high-lux", "onelux", "light", ">", 4_194_304),
    Rule("low-hum", "hum", "humidity", "<", 100),
    Rule("high-hum", "hum", "humidity", ">", 9900),
    Rule("low-tmp", "tmp", "temperature", "<", 0),
    Rule("high-tmp", "tmp", "temperature", ">", 10_000),
)

# Every meter that is reported; the sound meter has no live rule and stays at 0.
METERS = (
    "low-co2", "high-co2", "low-pa", "high-pa", "high-uv", "high-dust",
    "high-lux", "low-hum", "high-hum", "low-tmp", "high-tmp", "high-db",
)


def _part(point: str | Column, field: str) -> Column:
    """A field of a data point, which is a column or the name of one."""
    column = F.col(point) if isinstance(point, str) else point
    for name in field.split("."):
        column = column[name]
    return column


def value(rule: Rule, point: str | Column = "point") -> Column:
    column = _part(point, rule.field)
    if rule.field in ("light", "light_sensor.uv_count"):
        return F.coalesce(column, F.lit(0))
    return column


def breaks(rule: Rule, point: str | Column = "point") -> Column:
    """True when the point has the reading and it is outside the threshold; never null.

    A light reading has no presence mark of its own: the newer hardware, known by its light
    sensor, uses the first rule and all other hardware the second.
    """
    reading = value(rule, point)
    outside = reading < rule.threshold if rule.compare == "<" else reading > rule.threshold
    sensor = _part(point, "light_sensor")
    if rule.label in ("uv", "onefivelux"):
        outside = sensor.isNotNull() & outside
    elif rule.label == "onelux":
        outside = sensor.isNull() & outside
    return F.coalesce(outside, F.lit(False))
