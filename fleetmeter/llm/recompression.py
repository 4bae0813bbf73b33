"""Removal of repeated word windows by recompression.

Every document's words are renamed in rounds. A round first replaces each run of equal symbols by one symbol, then each
pair whose left symbol is in one half of the alphabet and whose right symbol is in the other; the halves are drawn by
hash. A new name is a fingerprint of what it replaces, so all tasks give equal things equal names without meeting. Each
symbol knows the words that its being there depends on. Inside a window, the symbols that depend on nothing outside are
the same wherever the window occurs.

Two Spark rounds compare names. In the first, pairs of high symbols (dozens of words) find long repeats, and every
window is represented by the least triple of low symbols that depends on the window alone: a window whose triple occurs
nowhere else is unique. In the second, the windows that are still open are compared by 96-bit names of their words.
Windows inside a long repeat of something earlier need no second look, here or as anyone's earlier occurrence, since
the earliest occurrence of a window is never inside one.

A null text has no words. Documents with fewer words than a window lose none. A null id counts as the smallest. Of rows
that repeat an id and a text, none is earlier than the other. An empty table gives no rows. A document is one unit
of work, so its length must fit a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fleetmeter.llm import exchange as X
from fleetmeter.llm.common import Block, arrow_map, mix, stored, words_of

WINDOW = 20
#: Rounds to the low symbols (about two words) and to the high ones (about eighteen).
LOW, HIGH = 2, 10
_FAR = 1 << 40
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Symbols:
    """The symbols of a block's documents: name, document, first word, and the words they depend on."""

    def __init__(self, name: np.ndarray, doc: np.ndarray):
        self.name, self.doc = name, doc
        self.start = self.low = self.high = np.arange(len(name))

    def _neighbours(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """low of the symbol before and high of the one after; far away at the ends of a document."""
        before, after = np.full(len(low), -_FAR), np.full(len(high), _FAR)
        same = self.doc[1:] == self.doc[:-1]
        before[1:][same] = low[:-1][same]
        after[:-1][same] = high[1:][same]
        return before, after

    def round(self, number: int) -> None:
        if not len(self.name):
            return
        before, after = self._neighbours(self.low, self.high)
        new = np.ones(len(self.name), bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | (self.doc[1:] != self.doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(new)) - 1
        size = (last - first + 1).astype(np.uint64)
        runs = mix(self.name[first] * _A + size)
        self.name = np.where(size > 1, runs, self.name[first])
        self.doc, self.start, self.low, self.high = self.doc[first], self.start[first], before[first], after[last]

        right = (mix(self.name + np.uint64(number) * _B) & np.uint64(1)).astype(bool)
        pair = np.zeros(len(self.name), bool)
        pair[:-1] = ~right[:-1] & right[1:] & (self.doc[1:] == self.doc[:-1])
        tail = np.zeros(len(self.name), bool)
        tail[1:] = pair[:-1]
        before, after = self._neighbours(self.low, self.high)
        low, high = np.where(right, before, self.low), np.where(right, self.high, after)
        at = np.flatnonzero(pair)
        low[at], high[at] = self.low[at], self.high[at + 1]
        name = self.name.copy()
        name[at] = mix(self.name[at] * _B + mix(self.name[at + 1] + _C))
        keep = ~tail
        self.name, self.doc, self.start, self.low, self.high = name[keep], self.doc[keep], self.start[keep], low[keep], high[keep]


class Parsed:
    """The words of a block, its windows, their representatives and its long repeats' candidates."""

    def __init__(self, ids: list[int | None], texts: list[bytes], window: int = WINDOW):
        self.block, self.window = Block(texts), window
        self.first, self.last, word = words_of(self.block.data)
        owner = self.block.owner(self.first)
        self.sizes = self.block.tally(owner)
        self.begin = np.cumsum(self.sizes) - self.sizes
        ids = np.array([X.NO_ID if i is None else i for i in ids], np.int64)
        self.id, self.pos = ids[owner], (np.arange(len(word)) - self.begin[owner]).astype(np.int32)
        self.total, self.back = self._sums(word * _A, 1), self._sums(mix(word + _B), 2)
        self.opens = np.flatnonzero(self.pos + window <= self.sizes[owner])  # the first words of windows
        self._represent(word, owner)

    def _sums(self, values: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        base = 0xD6E8FEB86659FD93 + 4 * which
        up, down = np.full(len(values) + 1, base, np.uint64), np.full(len(values) + 1, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=total[1:])
        return total, down, up

    def names(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 and 32 bits that name the words first..last-1."""
        (a, da, _), (b, db, _) = self.total, self.back
        key = mix((a[last] - a[first]) * da[first] + (last - first).astype(np.uint64))
        check = mix((b[last] - b[first]) * db[first]) >> np.uint64(32)
        return key, check.astype(np.uint32)

    def _represent(self, word: np.ndarray, owner: np.ndarray) -> None:
        symbols = Symbols(word, owner)
        for number in range(LOW):
            symbols.round(number)
        name, many = symbols.name, max(0, len(symbols.name) - 2)
        keys = mix(mix(name[:many] * _A + name[1 : many + 1]) * _B + name[2:])
        low, high = symbols.low[:many], symbols.high[2:]
        good = (symbols.doc[:many] == symbols.doc[2:]) & (low > -_FAR) & (high < _FAR)
        keys, low, high = keys[good], low[good], high[good]
        lo = np.searchsorted(low, self.opens, "left")
        hi = np.searchsorted(high, self.opens + self.window - 1, "right") - 1
        self.anchor = np.full(len(self.opens), -1)
        some = np.flatnonzero(hi >= lo)
        bits = np.uint64(max(1, int(len(keys)).bit_length()))
        ranked = (keys >> bits << bits) | np.arange(len(keys), dtype=np.uint64)
        least = X.minimum_of(ranked, lo[some], hi[some])
        self.anchor[some] = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        used, back = np.unique(self.anchor[some], return_inverse=True)
        self.anchor[some] = back
        self.triples = X.Keys(mix(keys[used] + _C), np.zeros(len(used), np.uint32))

        for number in range(LOW, HIGH):
            symbols.round(number)
        same = np.flatnonzero(symbols.doc[:-1] == symbols.doc[1:])
        ends = np.append(symbols.start[1:], len(word))
        whole = np.flatnonzero(self.sizes)
        self.long_first = np.concatenate([symbols.start[same], self.begin[whole]])
        self.long_last = np.concatenate([ends[same + 1], (self.begin + self.sizes)[whole]])
        key, check = self.names(self.long_first, self.long_last)
        self.long = X.Keys(key, check, self.id[self.long_first], self.pos[self.long_first])

    def first_questions(self, buckets: int):
        yield from ((0, *row) for row in self.triples.rows(buckets))
        yield from ((1, *row) for row in self.long.rows(buckets))

    def open_windows(self, buckets: int, answers: dict) -> tuple[np.ndarray, np.ndarray]:
        """Windows that a long repeat covers, and the windows that need a second look."""
        shared, _ = self.triples.answers(buckets, X.of_kind(answers, 0))
        _, before = self.long.answers(buckets, X.of_kind(answers, 1))
        first = self.long_first
        gone = before[self.long.index] | self.long.later(self.id[first], self.pos[first])
        wide = gone & (self.long_last - first >= self.window)
        inside = X.covered(len(self.pos) + 1, first[wide], self.long_last[wide] - self.window + 1)[self.opens]
        # a triple that several windows of this block have apart from each other is shared as well
        own = np.bincount(self.triples.index, minlength=len(self.triples.key)) > 1
        common = np.concatenate([(shared | own)[self.triples.index], [True]])
        return inside, np.flatnonzero(common[self.anchor] & ~inside)

    def windows(self, which: np.ndarray) -> X.Keys:
        at = self.opens[which]
        return X.Keys(*self.names(at, at + self.window), self.id[at], self.pos[at])

    def removed(self, buckets: int, answers: dict) -> np.ndarray:
        """Whether each word goes."""
        inside, which = self.open_windows(buckets, answers)
        keys = self.windows(which)
        _, before = keys.answers(buckets, X.of_kind(answers, 2))
        at = self.opens[which]
        inside[which] = before[keys.index] | keys.later(self.id[at], self.pos[at])
        at = self.opens[inside]
        return X.covered(len(self.pos), at, at + self.window)


def remove_repeats(docs: DataFrame, window: int = WINDOW, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and with `texts` the kept words joined by blanks."""
    blocks = stored(X.blocks_of(docs), "recompression-blocks")
    buckets = X.buckets_for(blocks)

    def first(block: int, payload: bytes, answers: dict):
        yield from Parsed(*X.opened(payload), window).first_questions(buckets)

    def second(block: int, payload: bytes, answers: dict):
        parsed = Parsed(*X.opened(payload), window)
        _, which = parsed.open_windows(buckets, answers)
        yield from ((2, *row) for row in parsed.windows(which).rows(buckets))

    def settle(rows):
        return X.settled(int(rows["kind"].iloc[0]) != 0)(rows)

    names = X.answered(X.ask(blocks, first), settle, "recompression-names")
    known = X.with_answers(blocks, names)
    looked = X.answered(X.ask(known, second), settle, "recompression-windows")
    both = names.withColumnRenamed("answers", "one").join(looked.withColumnRenamed("answers", "two"), "block", "full")
    both = both.selectExpr("block", "concat(coalesce(one, array()), coalesce(two, array())) as answers")
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["text"] * texts

    def make():
        def work(batch: pa.RecordBatch):
            for row in batch.to_pylist():
                ids, raw = X.opened(row["payload"])
                parsed = Parsed(ids, raw, window)
                gone = parsed.removed(buckets, X.given(row))
                lost = np.concatenate([[0], np.cumsum(gone)])
                size, begin = parsed.sizes, parsed.begin
                out = []
                for i, text in enumerate(raw):
                    words = text.split()
                    if lost[begin[i] + size[i]] > lost[begin[i]]:
                        words = [w for w, g in zip(words, gone[begin[i] : begin[i] + size[i]].tolist(), strict=True) if not g]
                    out.append(b" ".join(words))
                arrays = [pa.array(ids, pa.int64()), pa.array(size), pa.array(lost[begin + size] - lost[begin])]
                arrays.append(pa.array([hashlib.sha256(t).hexdigest() for t in out]))
                if texts:
                    arrays.append(pa.array(out, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, columns)

        return work

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * texts
    return arrow_map(X.with_answers(blocks, both), schema, make)
