"""Arrival order of records.

State tables are last-write-wins by *arrival*, never by event time: a late or out-of-order reading
overwrites a newer one. Sequence numbers are digit strings that may be far wider than any numeric
type, so they compare by length first and text second.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def arrival(position: str | None = None) -> Column:
    """Sort key of a record, or of one element of its repeated field when ``position`` is given.

    The shard is only a tie-break between records of different shards with equal numbers.
    """
    parts = [
        F.length("sequence_number").alias("digits"),
        F.col("sequence_number").alias("number"),
        F.col("shard_id").alias("shard"),
    ]
    if position is not None:
        parts.append(F.col(position).alias("position"))
    return F.struct(*parts)
