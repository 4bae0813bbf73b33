"""Stored tables: decoded messages, the position index and a scratch place all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter import schemas
from fleetmeter.functions.clock import DAY_MS


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where the setting is missing, only a local session may fall back to a local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="fleetmeter-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows kept in the scratch place, where they survive the loss of an executor."""
    path = scratch_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def decode_once(parsed: DataFrame, purpose: str) -> DataFrame:
    """Parsed records, malformed ones included, kept in the scratch place without their payloads.

    For queries with several branches: parsing costs far more than writing and reading columns.
    """
    return stored(parsed.drop("payload"), purpose)


def write_decoded(messages: DataFrame, path: str) -> None:
    """Decoded messages by arrival day, so a report on some days reads only those."""
    day = F.timestamp_millis(F.col("arrival_ms") - F.pmod("arrival_ms", F.lit(DAY_MS))).cast("date")
    messages.withColumn("arrival_day", day).write.mode("overwrite").partitionBy("arrival_day").parquet(path)


def read_decoded(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def create_checkpoint_table(spark: SparkSession, name: str) -> None:
    """The position index, keyed by (stream_shard_id, created_at); nothing happens when it exists."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schemas.CHECKPOINT_TRACK.toDDL()}) USING parquet")
