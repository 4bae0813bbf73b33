"""Best-fit packing of tokenised documents into sequences of a fixed length.

Best-fit decreasing only looks at lengths, and there are at most `limit` of them. So the driver packs the histogram of
lengths (its size is bounded by `limit`, whatever the input), with a segment tree that finds the tightest open capacity.
A step places many documents of one length into many bins of one capacity, exactly as one by one would. The plan is a
list of intervals of ranks; a document finds its bin from its rank among those of its length. Ranks come from counts
per (bucket, length), so a length that a third of all documents share is dealt over all buckets.

Null texts are empty: they hold the end token alone. An empty table gives no rows. Rows that repeat are packed each.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.llm.common import PASS_BYTES, arrow_map, slices, stored, texts_of

LIMIT = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: A blank before white space or the end, which a split at blanks would cut differently, and the special token.
_UNEVEN = re.compile(r" (?=\s|$)|<\|endoftext\|>|\x00")
#: Words whose tokens a task remembers.
CACHE = 250_000


class Encoder:
    """Token ids of texts as little-endian bytes, equal to those of the tokenizers library.

    A blank before a visible character always begins a token, so the pieces between blanks are encoded once each and
    remembered. New pieces of a pass are encoded together. Uneven texts go through the tokenizers library whole.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(json_path)
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, number in ranks.items():
            self.sizes[number] = len(token)
        self.known: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        """Remember the ids of pieces that begin with a blank."""
        ids = np.array(self.fast.encode_ordinary("".join(pieces)), "<u4")
        ends = np.cumsum(self.sizes[ids])
        cuts = np.searchsorted(ends, np.cumsum([len(p.encode()) for p in pieces]), "left") + 1
        raw, at = ids.tobytes(), 0
        for piece, cut in zip(pieces, cuts.tolist(), strict=True):
            self.known[piece] = raw[4 * at : 4 * cut]
            at = cut

    def _first(self, piece: str) -> bytes:
        return np.array(self.fast.encode_ordinary(piece), "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > CACHE:
            self.known.clear()
        split = [None if _UNEVEN.search(t) else t.replace(" ", "\x00 ").split("\x00") for t in texts]
        seen = set().union(*(p[1:] for p in split if p))
        new = [p for p in seen if p not in self.known]
        if new:
            self._learn(new)
        get = self.known.__getitem__
        return [
            np.array(self.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            if p is None
            else self._first(p[0]) + b"".join(map(get, p[1:]))
            for t, p in zip(texts, split, strict=True)
        ]


def pieces_of(size: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than the limit."""
    first = size % limit or limit
    return [(0, first), *((s, limit) for s in range(first, size, limit))]


def tokenised(
    docs: DataFrame, json_path: str, ranks_path: str, pattern: str, limit: int = LIMIT, ids: bool = False
) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, and with `ids` the ids as little-endian bytes."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids

    def make():
        encoder = Encoder(json_path, ranks_path, pattern)

        def work(batch: pa.RecordBatch):
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(np.array([len(t) for t in texts]), PASS_BYTES):
                out: list[list] = [[] for _ in names]
                for key, raw in zip(keys[a:b], encoder.encode(texts[a:b]), strict=True):
                    raw += b"\0\0\0\0"
                    for k, (start, length) in enumerate(pieces_of(len(raw) // 4, limit)):
                        own = raw[4 * start : 4 * (start + length)]
                        for column, value in zip(out, (key, k, start, length, zlib.crc32(own), own), strict=False):
                            column.append(value)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=False)], names)

        return work

    return arrow_map(texts_of(docs), PIECES + ", ids binary" * ids, make)


class Capacities:
    """Segment tree over capacities 0..limit; a leaf is set while bins of that capacity are open."""

    def __init__(self, limit: int):
        self.width = 1 << limit.bit_length()
        self.open = [False] * (2 * self.width)

    def mark(self, capacity: int, is_open: bool) -> None:
        i = capacity + self.width
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest open capacity that is at least `least`."""
        i = least + self.width
        while not self.open[i]:
            while i & 1:
                i //= 2
            if not i:
                return None
            i += 1
            if i & (i - 1) == 0:
                return None
        while i < self.width:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.width


def best_fit(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing of a histogram of lengths, as (length, from rank, to rank, per bin, first bin, offset).

    The document of rank r is in bin `first bin + (r - from) // per bin`, at `offset + (r - from) % per bin * length`.
    Ties go to the bins that reached their capacity first.
    """
    tree, bins, plan, made = Capacities(limit), {}, [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                per = limit // length
                bins[limit] = [(made, -(-left // per))]
                made += -(-left // per)
                tree.mark(limit, True)
                continue
            first, many = bins[room][0]
            per = room // length
            full = min(many, left // per)
            taken = full or 1
            placed = full * per or left
            plan.append((length, rank, rank + placed, per, first, limit - room))
            rank, left = rank + placed, left - placed
            bins[room][0:1] = [(first + taken, many - taken)] if many > taken else []
            if not bins[room]:
                tree.mark(room, False)
            rest = room - (per if full else placed) * length
            bins.setdefault(rest, []).append((first, taken))
            tree.mark(rest, True)
    return plan


def packed(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The rows of `pieces` with sequence_id and offset."""
    spark = pieces.sparkSession
    deal = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "piece", "ids_crc32"]
    dealt = pieces.withColumn("deal", F.pmod(F.xxhash64(*order), F.lit(deal)).cast("int"))
    counts = dealt.groupBy("deal", "length").agg(F.count("*").alias("many"))
    before = F.sum("many").over(Window.partitionBy("length").orderBy("deal")) - F.col("many")
    base = stored(counts.withColumn("base", before), "packing-base")
    plan = best_fit({r["length"]: r["many"] for r in base.groupBy("length").agg(F.sum("many").alias("many")).collect()}, limit)
    table = np.array(plan, np.int64).reshape(-1, 6)
    span = int(table[:, 2].max(initial=0)) + 1
    place = table[:, 0] * span + table[:, 1]
    order_by = np.argsort(place, kind="stable")
    table, place = table[order_by], place[order_by]

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            row = table[np.searchsorted(place, length * span + rank, "right") - 1]
            inside = rank - row[:, 1]
            arrays = [batch.column(n) for n in kept]
            bins, offset = row[:, 4] + inside // row[:, 3], row[:, 5] + inside % row[:, 3] * length
            return pa.RecordBatch.from_arrays([*arrays, pa.array(bins), pa.array(offset)], [*kept, "sequence_id", "offset"])

        return work

    kept = pieces.columns
    local = F.row_number().over(Window.partitionBy("deal", "length").orderBy(*order))
    ranked = dealt.withColumn("local", local).join(base.select("deal", "length", "base"), ["deal", "length"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("local") - 1).select(*kept, "rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return arrow_map(ranked, f"{schema}, sequence_id long, offset long", make)


def pack_documents(
    docs: DataFrame, json_path: str, ranks_path: str, pattern: str, limit: int = LIMIT, ids: bool = False
) -> DataFrame:
    """Tokenise, cut and pack documents; a row per piece."""
    return packed(stored(tokenised(docs, json_path, ranks_path, pattern, limit, ids), "packing-pieces"), limit)
