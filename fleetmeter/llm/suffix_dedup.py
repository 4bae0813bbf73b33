"""Removal of byte strings that an earlier document has, by longest-previous-factor arrays.

A byte goes if a string of `WINDOW` bytes over it also starts in a document with a smaller id. Each such string is
represented by an anchor, the least hash of the strings of `GRAM` bytes inside it, so equal strings share the anchor's
content. A first Spark round finds the anchors that several blocks have, and the long strings (from an anchor to the
second next, or a whole document) that an earlier document has; what lies inside those needs no second look, since the
earliest occurrence of a string is never inside one. The rest, runs of strings around a shared anchor, go to the bucket
of the anchor's hash. A bucket leaves out the strings whose 64-bit name no other has, sorts the rest, and computes for each
the longest factor (up to `WINDOW` bytes) that it shares with one of a smaller document: with the previous or the next
smaller document in suffix order. Later copies go, the first stays.

Null and empty texts have no bytes. Documents shorter than the window lose nothing. A null id counts as the smallest.
Rows that repeat an id don't count as earlier than each other. An empty table gives no rows. A document is one unit of
work, so its length must fit a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from fleetmeter.llm import exchange as X
from fleetmeter.llm.common import BYTE_HASH, Block, arrow_map, mix, powers, stored

WINDOW, GRAM = 50, 24
#: One in so many anchors bounds a long string.
THIN = 8
#: Bytes of text in a block.
SIZE = 1 << 20
_ODD = 0xD6E8FEB86659FD9D
_OTHER_HASH = mix(BYTE_HASH)


def summed(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums from the start of data, from which the hash of any of its strings follows."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers(len(data), _ODD, "suffix-up"), out=out[1:])
    return out


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` values in a row."""
    step = 1
    out = values
    while 2 * step <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


class Parsed:
    """The bytes of a block's documents, their strings' anchors, and the long strings."""

    def __init__(self, ids: list[int | None], texts: list[bytes], window: int = WINDOW, gram: int = GRAM):
        self.block, self.window = Block(texts), window
        data = self.block.data
        self.ids = np.array([X.NO_ID if i is None else i for i in ids], np.int64)
        sizes = self.block.ends - self.block.starts
        self.down = powers(len(data) + 1, pow(_ODD, -1, 1 << 64), "suffix-down")
        self.one, self.two = summed(data, BYTE_HASH), summed(data, _OTHER_HASH)
        # the first bytes of strings: those with `window` bytes left in their document
        self.opens = np.flatnonzero(X.covered(len(data), self.block.starts, np.maximum(self.block.starts, self.block.ends - window + 1)))
        bits = np.uint64(max(1, len(data).bit_length()))
        low = (np.uint64(1) << bits) - np.uint64(1)
        if len(self.opens):
            hashes = mix((self.one[gram:] - self.one[:-gram]) * self.down[:-gram])
            ranked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
            least = sliding_least(ranked, window - gram + 1)
            place = (least[self.opens] & low).astype(np.int64)
            del ranked, least
        else:
            hashes, place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        new = np.ones(len(place), bool)
        new[1:] = place[1:] != place[:-1]
        self.anchor = np.cumsum(new) - 1  # of each string
        at = place[new]
        self.anchors = X.Keys(mix(hashes[at] + np.uint64(7)), np.zeros(len(at), np.uint32))
        self.hash = mix(hashes[at] + np.uint64(7))
        owner = self.block.owner(at)
        edge = np.flatnonzero((hashes[at] >> np.uint64(60)) % np.uint64(THIN) == 0)
        far = edge[2:][owner[edge[2:]] == owner[edge[:-2]]] if len(edge) > 2 else edge[:0]
        near = edge[:-2][owner[edge[2:]] == owner[edge[:-2]]] if len(edge) > 2 else edge[:0]
        whole = np.flatnonzero(sizes >= window)
        self.long_first = np.concatenate([at[near], self.block.starts[whole]])
        self.long_last = np.concatenate([at[far] + gram, self.block.ends[whole]])
        doc = self.ids[self.block.owner(self.long_first)]
        self.long = X.Keys(*self.names(self.long_first, self.long_last), doc, np.zeros(len(doc), np.int32))
        self.long_doc = doc

    def names(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 and 32 bits that name the bytes first..last-1."""
        key = mix((self.one[last] - self.one[first]) * self.down[first] + (last - first).astype(np.uint64))
        check = mix((self.two[last] - self.two[first]) * self.down[first]) >> np.uint64(32)
        return key, check.astype(np.uint32)

    def first_questions(self, buckets: int):
        yield from ((0, *row) for row in self.anchors.rows(buckets))
        yield from ((1, *row) for row in self.long.rows(buckets))

    def runs(self, buckets: int, answers: dict):
        """Strings inside a long earlier one; and the open runs of strings around one shared anchor: their first and
        last string, their anchor's hash, the run of this block that stands for them, and whether that is earlier."""
        shared, _ = self.anchors.answers(buckets, X.of_kind(answers, 0))
        _, before = self.long.answers(buckets, X.of_kind(answers, 1))
        gone = before[self.long.index] | self.long.later(self.long_doc, np.zeros(len(self.long_doc), np.int32))
        wide = gone & (self.long_last - self.long_first >= self.window)
        inside = X.covered(len(self.block.data) + 1, self.long_first[wide], self.long_last[wide] - self.window + 1)
        inside = inside[self.opens]
        own = np.bincount(self.anchors.index, minlength=len(self.anchors.key)) > 1
        common = (shared | own)[self.anchors.index]
        live = np.flatnonzero(common[self.anchor] & ~inside)
        new = np.ones(len(live), bool)
        new[1:] = self.anchor[live][1:] != self.anchor[live][:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(live))[: len(first)] - 1
        first, last = live[first], live[last]
        hashes = self.hash[self.anchor[first]]
        doc = self.ids[self.block.owner(self.opens[first])]
        key, check = self.names(self.opens[first], self.opens[last] + self.window)
        same = X.Keys(key, check, doc, np.arange(len(doc), dtype=np.int32))
        return inside, first, last, hashes, doc, same

    def second_questions(self, buckets: int, answers: dict):
        """Per bucket the runs that stand for others: their documents, sizes and bytes."""
        _, first, last, hashes, doc, same = self.runs(buckets, answers)
        pack = zstandard.ZstdCompressor(level=1).compress
        for b, own in self.dealt(hashes, same, buckets):
            lo, size = self.opens[first[own]], self.opens[last[own]] + self.window - self.opens[first[own]]
            place = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
            parts = [np.array([len(own)], "<i8"), doc[own], size.astype("<i8"), self.block.data[place]]
            yield 2, b, pack(b"".join(p.tobytes() for p in parts))

    def dealt(self, hashes: np.ndarray, same: X.Keys, buckets: int):
        """(bucket, runs) of the runs that stand for others."""
        stands = same.pos  # the first run of each distinct content, that of the smallest document
        order = np.argsort(hashes[stands], kind="stable")
        for b, lo, hi in X.cuts(hashes[stands][order], buckets):
            yield b, stands[order[lo:hi]]

    def removed(self, buckets: int, answers: dict) -> np.ndarray:
        """Whether each byte goes."""
        inside, first, last, hashes, doc, same = self.runs(buckets, answers)
        size = last - first + 1
        given, verdict = X.of_kind(answers, 2), np.zeros(len(inside), bool)
        for b, own in self.dealt(hashes, same, buckets):
            if b in given:
                n = size[own]
                bits = np.unpackbits(np.frombuffer(given[b], np.uint8))[: n.sum()].astype(bool)
                place = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                verdict[place] = bits
        # every run takes over the verdict of the one that stands for it; later documents lose theirs to it
        stand = same.pos[same.index]
        place = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        source = np.repeat(first[stand] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        later = np.repeat(doc > doc[stand], size)
        inside[place] |= verdict[source] | later
        at = self.opens[inside]
        return X.covered(len(self.block.data) + 1, at, at + self.window)[:-1]


def repeated(data: np.ndarray, place: np.ndarray, window: int) -> np.ndarray:
    """Of the places, those whose string has a name that another place's has too: all that can be copies, and few others."""
    total = summed(data, BYTE_HASH)
    down = powers(len(data) + 1, pow(_ODD, -1, 1 << 64), "suffix-down")
    name = mix((total[place + window] - total[place]) * down[place])
    order = np.argsort(name)
    new = np.ones(len(order) + 1, bool)
    new[1:-1] = np.diff(name[order]) != 0
    return np.sort(order[~(new[:-1] & new[1:])])


def _to_smaller(doc: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each place in suffix order, the bytes it shares with the nearest one before it of a smaller document; 0 if none.

    All places jump at once: a place that points at one of no smaller document takes over where that one points, since
    nothing in between is smaller, and the least of both common lengths.
    """
    at, shared = np.arange(len(doc)) - 1, np.concatenate([[0], common])[: len(doc)]
    live = np.arange(len(doc))
    while True:
        live = live[(at[live] >= 0) & (shared[live] > 0)]
        live = live[doc[at[live]] >= doc[live]]
        if not len(live):
            break
        over = at[live]
        shared[live], at[live] = np.minimum(shared[live], shared[over]), at[over]
    return np.where(at >= 0, shared, 0)


def longest_previous(strings: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each row of bytes, the longest start it shares with one of a smaller document: in suffix order that is the
    previous or the next place of a smaller document. Bytes are sorted and compared themselves."""
    if not len(doc):
        return np.zeros(0, np.int64)
    width = strings.shape[1]
    order = np.argsort(np.ascontiguousarray(strings).view(f"S{width}").ravel(), kind="stable")
    rows, owner = strings[order], doc[order]
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(1), differ.argmax(1), width)
    before, after = _to_smaller(owner, common), _to_smaller(owner[::-1], common[::-1])[::-1]
    out = np.empty(len(doc), np.int64)
    out[order] = np.maximum(before, after)
    return out


def _settled(window: int):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["kind"].iloc[0] != 2:
            return X.settled(rows["kind"].iloc[0] == 1)(rows)
        unpack = zstandard.ZstdDecompressor().decompress
        docs, sizes, data, many = [], [], [], []
        for payload in rows["payload"]:
            raw = unpack(payload)
            n = int(np.frombuffer(raw, "<i8", 1)[0])
            docs.append(np.frombuffer(raw, "<i8", n, 8))
            sizes.append(np.frombuffer(raw, "<i8", n, 8 + 8 * n))
            data.append(np.frombuffer(raw, np.uint8, -1, 8 + 16 * n))
            many.append(int((sizes[-1] - window + 1).sum()))
        doc, size = np.concatenate(docs), np.concatenate(sizes)
        start = np.cumsum(size) - size
        whole, n = np.concatenate(data), size - window + 1
        place = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        some = repeated(whole, place, window)
        strings = np.lib.stride_tricks.sliding_window_view(whole, window)[place[some]]
        hit = np.zeros(len(place), bool)
        hit[some] = longest_previous(strings, np.repeat(doc, n)[some]) == window
        ends = np.cumsum(many)
        bits = [np.packbits(hit[e - m : e]).tobytes() if hit[e - m : e].any() else None for e, m in zip(ends, many, strict=True)]
        return X.told(rows, bits)

    return work


def _decided(docs: DataFrame, window: int, gram: int, whole: bool = False) -> tuple[DataFrame, int]:
    """Blocks with all their answers, and the number of buckets."""
    blocks = stored(X.blocks_of(docs, SIZE, whole), "suffix-blocks")
    buckets = X.buckets_for(blocks)

    def first(block: int, payload: bytes, answers: dict):
        yield from Parsed(*X.opened(payload), window, gram).first_questions(buckets)

    def second(block: int, payload: bytes, answers: dict):
        yield from Parsed(*X.opened(payload), window, gram).second_questions(buckets, answers)

    settle = _settled(window)
    names = X.answered(X.ask(blocks, first), settle, "suffix-anchors")
    looked = X.answered(X.ask(X.with_answers(blocks, names), second), settle, "suffix-runs")
    both = names.withColumnRenamed("answers", "one").join(looked.withColumnRenamed("answers", "two"), "block", "full")
    both = both.selectExpr("block", "concat(coalesce(one, array()), coalesce(two, array())) as answers")
    return X.with_answers(blocks, both), buckets


def _kept(row: dict, buckets: int, window: int, gram: int):
    """Of each document of a block: its id, its text, its bytes that stay, and the number of removed runs."""
    ids, raw = X.opened(row["payload"])
    parsed = Parsed(ids, raw, window, gram)
    gone = parsed.removed(buckets, X.given(row))
    for i, a, b, text in zip(ids, parsed.block.starts.tolist(), parsed.block.ends.tolist(), raw, strict=True):
        lost = gone[a:b]
        if lost.any():
            yield i, text, parsed.block.data[a:b][~lost].tobytes(), int(np.count_nonzero(np.diff(lost, prepend=False) & lost))
        else:
            yield i, text, text, 0


def remove_copies(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with `texts` the bytes that stay."""
    blocks, buckets = _decided(docs, window, gram)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * texts

    def make():
        def work(batch: pa.RecordBatch):
            for row in batch.to_pylist():
                ids, raw, kept, spans = zip(*_kept(row, buckets, window, gram), strict=True)
                arrays = [pa.array(ids, pa.int64()), pa.array([len(t) for t in raw], pa.int64())]
                arrays += [pa.array([len(t) - len(k) for t, k in zip(raw, kept, strict=True)], pa.int64())]
                arrays += [pa.array(spans, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(kept, pa.binary())] * texts, columns)

        return work

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    return arrow_map(blocks, schema, make)


def replace_texts(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of docs with the text that stays; a character that a removal cuts into goes whole. Null stays null."""
    blocks, buckets = _decided(docs, window, gram, whole=True)
    rest = [f for f in docs.schema.fields if f.name != "text"]

    def make():
        def work(batch: pa.RecordBatch):
            for row in batch.to_pylist():
                kept = [k.decode("utf-8", "ignore") for _, _, k, _ in _kept(row, buckets, window, gram)]
                null = pa.ipc.open_stream(row["payload"]).read_all().column("text").combine_chunks().is_null()
                text = pa.array(kept, pa.string(), mask=null.to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([X.rest_of(row["payload"]), text], ["rest", "text"])

        return work

    kinds = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in rest)
    out = arrow_map(blocks, f"rest struct<{kinds}>, text string", make)
    return out.select(*("text" if c == "text" else f"rest.`{c}`" for c in docs.columns))
