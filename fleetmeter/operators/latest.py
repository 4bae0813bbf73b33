"""Last-write-wins reduction.

``reduce_latest`` is associative and idempotent: reducing the union of two reduced tables equals
reducing the union of their inputs. Batch queries, stream batches and merges of stored changes all
use it. It is one aggregate with map-side partials, so a key that holds much of the input is
combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reduce_latest(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Per key, the values of the row that arrived last, with its ``arrival``."""
    newest = F.max(F.struct("arrival", *values)).alias("newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "newest.*")
