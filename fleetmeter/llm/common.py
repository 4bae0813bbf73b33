"""Helpers that several operators share: scratch tables, Arrow mapping, blocks of documents, hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass works on at a time.
PASS_BYTES = 1 << 18


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir. Only a local session may leave that setting out."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to shared storage and read back: what follows doesn't recompute it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def arrow_map(df: DataFrame, schema: str, make: Callable[[], Callable]) -> DataFrame:
    """mapInArrow; make() runs once in each task and gives the function of a batch (to a batch, or batches)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            out = work(batch)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out
        del work
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):  # workers live on: what the task freed goes back
            pool.release_unused()

    return df.mapInArrow(run, schema)


def slices(sizes: np.ndarray, most: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about `most`."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        total += int(n)
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, base: int, key: str) -> np.ndarray:
    """The first n powers of base; kept under `key`."""
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        size = max(n, 2 * PASS_BYTES)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _POWERS[key] = have = np.multiply.accumulate(have)
    return have[:n]


_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def runs_of(data: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, 64-bit hashes) of the longest runs of bytes outside `gap`; a hash depends on those bytes alone."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    edge = np.flatnonzero(np.diff(gap[data], prepend=True, append=True))
    starts, ends = edge[0::2], edge[1::2]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_HASH[data] * powers(len(data), _BASE, "up"), out=total[1:])
    raw = (total[ends] - total[starts]) * powers(len(data), _INVERSE, "down")[starts]
    return starts, ends, mix(raw + (ends - starts).astype(np.uint64))


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, 64-bit hashes) of the words of UTF-8 bytes."""
    return runs_of(data, SPACE)


class Block:
    """Texts side by side, a line feed between them."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"\n".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        self.ends = self.starts + sizes
        self.many = len(texts)

    def owner(self, places: np.ndarray) -> np.ndarray:
        """The text that each byte place is in."""
        return np.searchsorted(self.starts, places, "right") - 1

    def count(self, table: np.ndarray) -> np.ndarray:
        """For each text, its bytes that `table` marks."""
        total = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(table[self.data], out=total[1:])
        return total[self.ends] - total[self.starts]

    def tally(self, owners: np.ndarray) -> np.ndarray:
        return np.bincount(owners, minlength=self.many).astype(np.int64)


def byte_table(*marked: int | range) -> np.ndarray:
    table = np.zeros(256, bool)
    for m in marked:
        table[m] = True
    return table


def finite_vectors(vectors: DataFrame, key: str, vector: str, *keep: str) -> DataFrame:
    """id, the `keep` columns and x (doubles) of the rows whose vector is not null and holds finite components alone."""
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), *(F.col(k).alias(k) for k in keep), F.col(vector).cast("array<double>").alias("x")
    )
    bad = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("x").isNotNull()).where(~bad)


def list_matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
