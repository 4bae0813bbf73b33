"""Raw streams as tables or streams of ``schemas.RAW`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter import schemas
from fleetmeter.functions.clock import utc_session

# Files per fetch stand in for the record cap of a fetch; pause between two reads.
MAX_FILES_PER_TRIGGER = 1000
READ_INTERVAL = "10 seconds"


def read_batch(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return utc_session(spark).read.format(fmt).schema(schemas.RAW).load(path)


def read_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files: int = MAX_FILES_PER_TRIGGER,
    start_ms: int | None = None,
) -> DataFrame:
    """A bounded read per trigger; ``start_ms`` skips records that arrived earlier (newest only)."""
    stream = (
        utc_session(spark)
        .readStream.format(fmt)
        .schema(schemas.RAW)
        .option("maxFilesPerTrigger", max_files)
        .load(path)
    )
    return stream if start_ms is None else stream.where(F.col("arrival_ms") >= start_ms)


def from_broker(records: DataFrame) -> DataFrame:
    """Raw rows from a broker source with columns partition, offset, timestamp and value.

    These are the columns of Spark's Kafka source, batch or stream. The start position and the
    record cap are options of that source (``startingOffsets``, ``maxOffsetsPerTrigger``).
    """
    return records.select(
        F.format_string("shardId-%012d", F.col("partition")).alias("shard_id"),
        F.col("offset").cast("string").alias("sequence_number"),
        F.unix_millis("timestamp").alias("arrival_ms"),
        F.col("value").alias("payload"),
    )
