"""Blocks of documents, and questions that blocks put to each other.

Documents are stored in compressed blocks of about `BLOCK` bytes of text, one row each. A block asks about keys:
for each it sends a row per bucket with its distinct keys and, where order matters, the least place (document, position)
it has for each. A bucket meets all blocks' keys of a hash range, and answers with two bits a key: does another block
have it, and does another block have it at a smaller place. However often a key occurs, a block sends it once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm.common import arrow_map, slices, stored, text_bytes, texts_of

BLOCK = 1 << 20
#: Bytes of text for each bucket.
BUCKET = 4 << 20
#: What a null id counts as: smaller than all others.
NO_ID = -(1 << 63)


def blocks_of(docs: DataFrame, size: int = BLOCK, whole: bool = False) -> DataFrame:
    """block, size and payload: the ids and texts of about `size` bytes of text as a compressed Arrow table. With
    `whole`, each row's other columns travel along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            plain = pa.table({"doc_id": batch.column(0), "text": batch.column(1).cast(pa.binary())})
            if whole:
                plain = plain.append_column("rest", batch.column(2))
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for a, b in slices(sizes, size):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, plain.schema, options=options) as out:
                    out.write_table(plain.slice(a, b - a))
                row = [[number], [int(sizes[a:b].sum())], [sink.getvalue().to_pybytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["block", "size", "payload"])
                number += 1

    rows = texts_of(docs)
    if whole:
        rest = F.struct(*(c for c in docs.columns if c != "text"))
        rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), rest.alias("rest"))
    return rows.mapInArrow(run, "block long, size long, payload binary")


def opened(payload: bytes) -> tuple[list[int | None], list[bytes]]:
    """Ids and texts of a block."""
    table = pa.ipc.open_stream(payload).read_all()
    return table.column(0).to_pylist(), text_bytes(table.column(1).combine_chunks())


def rest_of(payload: bytes) -> pa.Array:
    """The other columns of a block's rows, as structs."""
    return pa.ipc.open_stream(payload).read_all().column("rest").combine_chunks()


class Keys:
    """Distinct 96-bit keys of a block, with the least place (document, position) of each."""

    def __init__(self, key: np.ndarray, check: np.ndarray, doc: np.ndarray | None = None, pos: np.ndarray | None = None):
        self.ordered = doc is not None
        if self.ordered:
            order = np.lexsort((pos, doc, check, key))
        else:
            order = np.lexsort((check, key))
        key, check = key[order], check[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
        self.index = np.empty(len(key), np.int64)  # of each row that was given, its distinct key
        self.index[order] = np.cumsum(new) - 1
        self.key, self.check = key[new], check[new]
        self.doc = doc[order][new] if self.ordered else None
        self.pos = pos[order][new] if self.ordered else None

    def later(self, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Whether each row that was given comes after the least place of its key in this block."""
        d, p = self.doc[self.index], self.pos[self.index]
        return (doc > d) | ((doc == d) & (pos > p))

    def rows(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        """A row per bucket."""
        for b, lo, hi in cuts(self.key, buckets):
            parts = [self.key[lo:hi], self.check[lo:hi]]
            if self.ordered:
                parts += [self.doc[lo:hi], self.pos[lo:hi]]
            yield b, b"".join(p.tobytes() for p in parts)

    def answers(self, buckets: int, given: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each distinct key: another block has it; another block has it at a smaller place."""
        shared, before = np.zeros(len(self.key), bool), np.zeros(len(self.key), bool)
        for b, lo, hi in cuts(self.key, buckets):
            if b in given:
                bits = np.unpackbits(np.frombuffer(given[b], np.uint8))[: 2 * (hi - lo)].astype(bool)
                shared[lo:hi], before[lo:hi] = bits[: hi - lo], bits[hi - lo :]
        return shared, before


def cuts(key: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted keys; buckets are equal ranges of the top 32 bits."""
    bucket = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    edge = np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets + 1), append=np.uint64(buckets + 1)))
    return [(int(bucket[a]), int(a), int(b)) for a, b in zip(edge[:-1], edge[1:], strict=True)]


def settled(ordered: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The answers of one bucket and kind."""
    width = 24 if ordered else 12

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = [len(p) // width for p in rows["payload"]]
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for payload, n in zip(rows["payload"], sizes, strict=True):
            at = 0
            for column, kind in zip(columns, ("<u8", "<u4", "<i8", "<i4")[: 4 if ordered else 2], strict=False):
                column.append(np.frombuffer(payload, kind, n, at))
                at += n * np.dtype(kind).itemsize
        key, check, doc, pos = (np.concatenate(c) if c else None for c in columns)
        by = (pos, doc, check, key) if ordered else (check, key)
        order = np.lexsort(by)
        new = np.ones(len(key), bool)
        k, c = key[order], check[order]
        new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
        group = np.cumsum(new) - 1
        shared = np.empty(len(key), bool)
        shared[order] = np.bincount(group)[group] > 1
        before = np.zeros(len(key), bool)
        if ordered:
            first = np.flatnonzero(new)[group]
            d, p = doc[order], pos[order]
            before[order] = (d > d[first]) | ((d == d[first]) & (p > p[first]))
        out, at = [], 0
        for n in sizes:
            some = np.concatenate([shared[at : at + n], before[at : at + n]])
            out.append(np.packbits(some).tobytes() if some.any() else None)
            at += n
        return told(rows, out)

    return work


def told(rows: pd.DataFrame, bits: list[bytes | None]) -> pd.DataFrame:
    """The answers to the rows that have one."""
    out = pd.DataFrame({"block": rows["block"], "kind": rows["kind"], "bucket": rows["bucket"], "bits": bits})
    return out[[b is not None for b in bits]]


ASKED = "block long, kind int, bucket int, payload binary"


def ask(blocks: DataFrame, work: Callable[[int, bytes, dict], Iterator[tuple[int, int, bytes]]]) -> DataFrame:
    """Rows (kind, bucket, payload) that `work` makes of each block and the answers that came with it."""

    def make():
        def one(batch: pa.RecordBatch):
            for row in batch.to_pylist():
                asked = list(work(row["block"], row["payload"], given(row)))
                if asked:
                    kinds, buckets, payloads = zip(*asked, strict=True)
                    arrays = [pa.array([row["block"]] * len(asked), pa.int64()), pa.array(kinds, pa.int32())]
                    arrays += [pa.array(buckets, pa.int32()), pa.array(payloads, pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, ["block", "kind", "bucket", "payload"])

        return one

    return arrow_map(blocks, ASKED, make)


def given(row: dict) -> dict[tuple[int, int], bytes]:
    """The answers in a row of a block, by kind and bucket."""
    return {(a["kind"], a["bucket"]): a["bits"] for a in row.get("answers") or ()}


def of_kind(answers: dict[tuple[int, int], bytes], kind: int) -> dict[int, bytes]:
    return {b: bits for (k, b), bits in answers.items() if k == kind}


def answered(asked: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], name: str) -> DataFrame:
    """Per block, the answers that are not all no."""
    bits = asked.groupBy("kind", "bucket").applyInPandas(work, "block long, kind int, bucket int, bits binary")
    return stored(bits.groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", "bits")).alias("answers")), name)


def with_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    return blocks.join(answers, "block", "left")


def buckets_for(blocks: DataFrame) -> int:
    return max(1, -(-(blocks.agg(F.sum("size")).first()[0] or 0) // BUCKET))


def covered(size: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether each of 0..size-1 is in one of the ranges first..last-1."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last, -1)
    return np.cumsum(change[:-1]) > 0


def minimum_of(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of values[first..last] of each range (not empty), by a table of powers of two."""
    out = np.empty(len(first), values.dtype)
    size = last - first + 1
    table, step = values, 1
    while True:
        pick = np.flatnonzero((size >= step) & (size < 2 * step))
        out[pick] = np.minimum(table[first[pick]], table[last[pick] - step + 1])
        if not len(size) or step * 2 > size.max():
            return out
        table = np.minimum(table[:-step], table[step:])
        step *= 2
