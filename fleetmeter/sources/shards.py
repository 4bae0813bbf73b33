"""Shard logs: a stream source that reads each shard by its offset, at most so many records of a shard per fetch.

A log is a folder of segments, ``segment=<n>/shard_id=<shard>/*.parquet``; a shard's records lie in it in the order of
segment, file and row, and their number in that order is the offset. An offset of the stream is one number per shard.
Only footers are read to find the end of a shard, and a fetch reads the row groups that it needs. A batch takes one fetch
of each shard or, where asked, several; each fetch is a task of its own, so a long log takes few batches and many cores.

The files are opened through ``pyarrow.fs``, so a log may lie wherever that reads: a local or mounted folder, HDFS, S3.
"""

from __future__ import annotations

import ast
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from fleetmeter import schemas
from fleetmeter.functions.arrival import arrival
from fleetmeter.functions.clock import utc_session

FORMAT = "shard_log"

# Records of a shard per fetch by default and at most.
RECORDS_PER_FETCH = 2000
MAX_RECORDS_PER_FETCH = 5000

# The folder of records without a shard.
NO_SHARD = "__HIVE_DEFAULT_PARTITION__"

_COLUMNS = ["sequence_number", "arrival_ms", "payload"]


def append(records: DataFrame, path: str, segment: int) -> None:
    """Write raw records as one segment of the log, each shard in arrival order.

    A shard's rows are one sorted task's, as an ordered log needs; a shard with many records is sorted with spilling.
    """
    rows = records.repartition("shard_id").sortWithinPartitions("shard_id", arrival())
    rows.write.partitionBy("shard_id").parquet(f"{path}/segment={segment:012d}")


def _place(path: str):
    from pyarrow import fs

    plain = path.removeprefix("file:")
    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), "/" + plain.lstrip("/")


class Fetch(InputPartition):
    """Records ``start`` to ``end`` (exclusive) of a shard: the ranges of rows of its files."""

    def __init__(self, shard: str, ranges: list[tuple[str, int, int]]):
        self.shard, self.ranges = shard, ranges


class ShardReader(DataSourceStreamReader):
    def __init__(self, path: str, newest: bool, most: int, checkpoint: str, fetches: int = 1):
        self.path, self.newest, self.most, self.checkpoint, self.fetches = path, newest, most, checkpoint, fetches
        self.sizes: dict[str, int] = {}  # of files that have been seen: files of a log never change
        self.first: dict[str, int] | None = None
        self.planned: dict[str, int] | None = None

    def _files(self) -> dict[str, list[tuple[str, int]]]:
        """The files of each shard in order, with their numbers of records; segments that are being written don't count."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, root = _place(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        done = {f.path.rsplit("/", 1)[0] for f in found if f.base_name == "_SUCCESS"}
        shards: dict[str, list[tuple[str, int]]] = {}
        for name in sorted(f.path for f in found if f.path.endswith(".parquet") and not f.base_name.startswith(("_", "."))):
            segment, shard, _ = name.rsplit("/", 2)
            if segment in done:
                if name not in self.sizes:
                    with store.open_input_file(name) as file:
                        self.sizes[name] = pq.read_metadata(file).num_rows
                shards.setdefault(shard.removeprefix("shard_id="), []).append((name, self.sizes[name]))
        return shards

    def _ends(self) -> dict[str, int]:
        return {shard: sum(n for _, n in files) for shard, files in self._files().items()}

    def _resumed(self) -> dict[str, int] | None:
        """The last offset that the query has planned before this reader, from its checkpoint."""
        from pyarrow import fs

        store, root = _place(self.checkpoint)
        found = store.get_file_info(fs.FileSelector(f"{root}/offsets", allow_not_found=True))
        batches = [f for f in found if f.base_name.isdigit()]
        if not batches:
            return None
        with store.open_input_file(max(batches, key=lambda f: int(f.base_name)).path) as file:
            lines = file.read().decode().split("\n")
        return json.loads(lines[2])  # the version, the batch, and the offset of the one source

    def initialOffset(self) -> dict:
        if self.first is None:
            self.first = self._ends() if self.newest else {}
        return self.first

    def latestOffset(self) -> dict:
        """At most ``fetches`` times ``most`` records of a shard beyond what was planned before."""
        if self.planned is None:
            resumed = self._resumed()
            self.planned = self.initialOffset() if resumed is None else resumed
        before = self.planned
        reach = self.most * self.fetches
        self.planned = {shard: min(end, before.get(shard, 0) + reach) for shard, end in self._ends().items()}
        return self.planned

    def partitions(self, start: dict, end: dict) -> list[Fetch]:
        fetches = []
        for shard, files in self._files().items():
            first, last = start.get(shard, 0), end.get(shard, 0)
            for low in range(first, last, self.most):
                high, at, ranges = min(low + self.most, last), 0, []
                for name, many in files:
                    if at < high and at + many > low:
                        ranges.append((name, max(low - at, 0), min(high - at, many)))
                    at += many
                if ranges:
                    fetches.append(Fetch(shard, ranges))
        return fetches

    def read(self, partition: Fetch) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        store, _ = _place(self.path)
        names = ["shard_id", *_COLUMNS]
        for name, low, high in partition.ranges:
            with store.open_input_file(name) as source:
                file, at = pq.ParquetFile(source), 0
                for group in range(file.num_row_groups):
                    many = file.metadata.row_group(group).num_rows
                    if at < high and at + many > low:
                        rows = file.read_row_group(group, _COLUMNS).slice(max(low - at, 0), min(high - at, many) - max(low - at, 0))
                        for batch in rows.to_batches():
                            shard = pa.array([None if partition.shard == NO_SHARD else partition.shard] * batch.num_rows, pa.string())
                            yield pa.RecordBatch.from_arrays([shard, *(batch.column(c) for c in _COLUMNS)], names)
                    at += many

    def commit(self, end: dict) -> None:
        pass


class ShardLog(DataSource):
    """Options: ``path``; ``checkpoint``, the query's checkpoint folder, from which a restart knows where it is; ``start``,
    "earliest" or "newest" (nothing that is in the log already is read); ``records`` of a shard per fetch; ``fetches`` of a
    shard per batch.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return schemas.RAW

    def streamReader(self, schema) -> ShardReader:
        start, most = self.options.get("start", "earliest"), int(self.options.get("records", RECORDS_PER_FETCH))
        if start not in ("earliest", "newest"):
            raise ValueError(f"start must be earliest or newest, not {start}")
        if not 1 <= most <= MAX_RECORDS_PER_FETCH:
            raise ValueError(f"records per fetch must be 1 to {MAX_RECORDS_PER_FETCH}")
        fetches = int(self.options.get("fetches", 1))
        if fetches < 1:
            raise ValueError("a batch takes at least one fetch of a shard")
        return ShardReader(self.options["path"], start == "newest", most, self.options["checkpoint"], fetches)


def read_stream(
    spark: SparkSession, path: str, checkpoint: str, start: str = "earliest", records: int = RECORDS_PER_FETCH, fetches: int = 1
) -> DataFrame:
    """The log as the one stream of a query with that checkpoint folder. A fetch holds at most ``records`` of a shard, a batch at
    most ``fetches`` of each shard."""
    utc_session(spark).dataSource.register(ShardLog)
    options = {"start": start, "records": records, "checkpoint": checkpoint, "fetches": fetches}
    return spark.readStream.format(FORMAT).options(**options).load(path)


def offsets(progress: dict) -> tuple[dict, dict]:
    """Start and end offsets of a batch, from the progress of a query."""
    source = progress["sources"][0]
    return tuple(ast.literal_eval(str(source[end])) or {} for end in ("startOffset", "endOffset"))
