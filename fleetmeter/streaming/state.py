"""Stateful processors keep their state in RocksDB, on the executors' disks and in the query's checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_rocksdb(rows: DataFrame) -> DataFrame:
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    return rows
