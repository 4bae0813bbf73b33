"""SentencePiece encoding and decoding: the segmentation of best score under a model file's pieces and scores.

Text gets a leading blank, blanks become the piece sign, and no piece has that sign anywhere but at its beginning. So a
segment always begins at a run of signs, and the words between are encoded once each by dynamic programming.

A document of more than `CHUNK` characters is cut into chunks of that size, wherever the cuts fall. A chunk is scored as
a max-plus matrix: for each place where the first piece of its own may begin (up to the longest piece into the chunk),
the best score to each place where the last of its pieces may end beyond it. A scan combines the matrices of a document
associatively into the scores with which every chunk is entered. With these, every chunk is traced back by itself, from
each state in which it may end; the document's path picks one trace of each.

Ties go to the longer last piece, at every place and in chunks as in whole texts, so the ids don't depend on the size of
chunks (scores that are whole numbers add up exactly; others to rounding). A character without a piece becomes byte
pieces, at the penalty that the unigram model of SentencePiece gives. A null or empty text has no pieces. Rows that
repeat are encoded each. An empty table gives no rows. Decoding returns the text; the piece sign itself is the one
character that comes back as a blank.

The scores of a BPE file are merge ranks, and its own encoding merges in their order, which no sum of scores expresses.
`n_model_pieces` and `model_crc32` are of the ids that the model itself gives.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Callable
from functools import lru_cache
from itertools import chain
from os.path import commonprefix

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm.common import PASS_BYTES, arrow_map, slices, stored, texts_of

CHUNK = 1 << 14
#: Words that a task remembers, and the most characters of one.
CACHE, SHORT = 300_000, 64
#: The library adds scores as 32-bit floats, exact up to 2 ** 24. Pieces down to -LIGHT are left as they are; the least
#: score counts as -HEAVY, more than the others of a short word together, and at most three of those are in exact sums.
LIGHT, HEAVY = 1 << 15, 1 << 22
SIGN = "▁"
_PART = re.compile(f"{SIGN}+[^{SIGN}]*")


def marked(text: str) -> str:
    return SIGN + text.replace(" ", SIGN) if text else ""


class Words(dict):
    """What `solve` gives for each word met so far. New words of a call are solved together."""

    def __init__(self, solve: Callable[[list[str]], list]):
        super().__init__()
        self.solve = solve

    def of(self, texts: list[list[str]]) -> list[list]:
        if len(self) > CACHE:
            self.clear()
        new = [part for part in set().union(*texts) if part not in self]
        if new:
            self.update(zip(new, self.solve(new), strict=True))
        got = [list(map(self.__getitem__, parts)) for parts in texts]
        for part in new:
            if len(part) > SHORT:
                del self[part]
        return got


class Model:
    """Pieces, scores and the dynamic programme over them."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        reader = sentencepiece.SentencePieceProcessor(model_file=path)
        many = range(reader.get_piece_size())
        self.bytes = {int(reader.id_to_piece(i)[1:-1], 16): i for i in many if reader.is_byte(i)}
        plain = [i for i in many if not (reader.is_byte(i) or reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i))]
        self.pieces = {reader.id_to_piece(i): (float(reader.get_score(i)), i) for i in plain}
        self.longest = max(map(len, self.pieces))
        self.reach: dict[str, int] = {}  # longest piece by its first two characters
        for piece in self.pieces:
            self.reach[piece[:2]] = max(self.reach.get(piece[:2], 1), len(piece))
        least = min(s for s, _ in self.pieces.values())
        self.unknown = least - 10.0
        self.raw = [b""] * len(many)
        self.worth = np.zeros(len(many))
        for piece, (score, i) in self.pieces.items():
            self.raw[i], self.worth[i] = piece.encode(), score
        for value, i in self.bytes.items():  # the first byte of a character carries its penalty
            self.raw[i], self.worth[i] = bytes([value]), 0.0 if 0x80 <= value < 0xC0 else self.unknown
        self.heavy = self.worth < -LIGHT

        file = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            file.ParseFromString(f.read())
        file.normalizer_spec.add_dummy_prefix = file.normalizer_spec.escape_whitespaces = False  # words come marked
        self.model = sentencepiece.SentencePieceProcessor(model_proto=file.SerializeToString())
        scores = {s for s, _ in self.pieces.values()}
        self.whole = all(s.is_integer() and (s >= -LIGHT or s == least) for s in scores)
        file.trainer_spec.model_type = file.trainer_spec.UNIGRAM
        for piece in file.pieces:
            if piece.score < -LIGHT:
                piece.score = -HEAVY
        self.best = sentencepiece.SentencePieceProcessor(model_proto=file.SerializeToString())
        self.known, self.scored, self.merged = Words(self._solved), Words(self._scored), Words(self._merged)
        self.narrow = "<u2" if len(many) <= 1 << 16 else "<u4"

    def paths(self, text: str, start: int, stop: int, entry: np.ndarray | None = None) -> tuple[list[float], list[int]]:
        """For each place, the best score and where the last piece begins. Pieces begin before `stop`.

        A path begins at `start`, or at any of the first places with the score that `entry` gives.
        """
        size, find, reach, shortest = len(text), self.pieces.get, self.reach.get, self.unknown
        best, back = [-np.inf] * (size + 1), [-1] * (size + 1)
        best[start] = 0.0
        if entry is not None:
            best[: len(entry)] = entry[: size + 1].tolist()
        for at in range(start, stop):
            so_far = best[at]
            if so_far == -np.inf:
                continue
            for end in range(min(size, at + reach(text[at : at + 2], 1)), at, -1):
                found = find(text[at:end])
                if found is not None and so_far + found[0] > best[end]:
                    best[end], back[end] = so_far + found[0], at
            if found is None and so_far + shortest > best[at + 1]:  # not even the character is a piece
                best[at + 1], back[at + 1] = so_far + shortest, at
        return best, back

    def ids(self, text: str, back: list[int], end: int) -> tuple[bytes, int]:
        """The ids of the path that ends at a place, and where it begins."""
        out: list[int] = []
        while back[end] >= 0:
            at = back[end]
            found = self.pieces.get(text[at:end])
            out.extend([found[1]] if found else [self.bytes[b] for b in reversed(text[at:end].encode())])
            end = at
        return np.array(out[::-1], "<u4").tobytes(), end

    def alone(self, part: str) -> tuple[float, bytes]:
        """Score and ids of one word."""
        best, back = self.paths(part, 0, len(part))
        return best[-1], self.ids(part, back, len(part))[0]

    def _scored(self, parts: list[str]) -> list[tuple[float, bytes]]:
        """Score and ids of many words. The library solves short ones, as far as its sums are exact."""
        short = [p for p in parts if len(p) <= SHORT] if self.whole else []
        got = self.best.encode(short, num_threads=1) if short else []
        flat = np.fromiter(chain.from_iterable(got), np.int64)
        ends = np.cumsum([0, *map(len, got)])
        scores = np.diff(np.concatenate([[0.0], np.cumsum(self.worth[flat])])[ends])
        exact = np.diff(np.concatenate([[0], np.cumsum(self.heavy[flat])])[ends]) <= 3
        done = {p: (s, array("I", i).tobytes()) for p, s, i, e in zip(short, scores.tolist(), got, exact.tolist(), strict=True) if e}
        return [done.get(p) or self.alone(p) for p in parts]

    def _merged(self, parts: list[str]) -> list[bytes]:
        return [array("I", i).tobytes() for i in self.model.encode(parts, num_threads=1)]

    def _solved(self, parts: list[str]) -> list[tuple[float, bytes, bytes]]:
        return [(*best, own) for best, own in zip(self._scored(parts), self._merged(parts), strict=True)]

    def encode_all(self, texts: list[str]) -> list[tuple[float, bytes, bytes]]:
        """Score and ids of each text, and the ids that the model itself gives."""
        out = []
        for words in self.known.of([_PART.findall(marked(text)) for text in texts]):
            scores, ids, own = zip(*words, strict=True) if words else ((), (), ())
            out.append((sum(scores), b"".join(ids), b"".join(own)))
        return out

    def encode(self, text: str) -> tuple[float, bytes]:
        return self.encode_all([text])[0][:2]

    def merge(self, text: str) -> bytes:
        """The ids that the model itself gives; no piece of it reaches over the beginning of a word either."""
        return b"".join(self.merged.of([_PART.findall(marked(text))])[0])

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
        return text.replace(SIGN, " ")[1:]

    # chunks: `text` holds the chunk's `size` characters and, after them, as many as a piece may reach beyond

    def transfer(self, text: str, size: int, before: str = "") -> tuple[np.ndarray, str, bytes | None, str]:
        """Best scores from a first piece at each of `longest` places to an end at each of as many beyond the chunk.

        Then the text up to the first beginning of a word, over which no piece reaches, the ids from there to the last one,
        and the text from there. The ids are None where these are too close, and the last text is all. `before` is the
        character before the chunk, if there is one.
        """
        out = np.full((self.longest, self.longest), -np.inf)
        walls = [m.start() for m in _PART.finditer(text, 0, size)]
        if before == SIGN and walls[:1] == [0]:  # inside a run of signs, which pieces may reach over
            walls = walls[1:]
        head, ids, rest = "", None, text
        if not walls or walls[-1] - walls[0] < self.longest:
            for e in range(min(self.longest, size)):
                self._leave(text, size, e, out[e])
        else:  # all paths meet at the first wall and at the last one
            words = self.scored.of([[text[a:b] for a, b in zip(walls[:-1], walls[1:], strict=True)]])[0]
            middle, ids = sum(word[0] for word in words), b"".join(word[1] for word in words)
            tail = np.full(self.longest, -np.inf)
            self._leave(text, size, walls[-1], tail)
            head, rest = text[: walls[0]], text[walls[-1] :]
            for e in range(min(self.longest, walls[0] + 1)):
                first = self.paths(head, e, walls[0])[0][-1] if e < walls[0] else 0.0
                out[e] = first + middle + tail
        for e in range(size, self.longest):  # the piece before reaches over the whole chunk
            out[e, e - size] = 0.0
        return out, head, ids, rest

    def _leave(self, text: str, size: int, start: int, row: np.ndarray) -> None:
        best, _ = self.paths(text, start, size)
        for x in range(min(self.longest, len(text) - size + 1)):
            row[x] = best[size + x]

    def trace(self, head: str, middle: bytes | None, rest: str, size: int, entry: np.ndarray) -> tuple[bytes, list[int], list[bytes]]:
        """The chunk's own ids for each state that it may end in: what all begin with, first states, what follows.

        `entry` holds the best score of the text before, by first state; `size` is what the chunk has of `rest`. A state
        that no path ends in has first state -1.
        """
        stem, first = b"", -1
        if middle is not None:  # one path up to the last wall
            _, back = self.paths(head, 0, len(head), entry)
            stem, first = self.ids(head, back, len(head))
            stem, entry = stem + middle, np.zeros(1)
        best, back = self.paths(rest, 0, size, entry)
        firsts, ends = [-1] * self.longest, [b""] * self.longest
        open_ = [x for x in range(min(self.longest, len(rest) - size + 1)) if best[size + x] != -np.inf]
        for x in open_:
            ends[x], at = self.ids(rest, back, size + x)
            firsts[x] = at if middle is None else first
        shared = commonprefix([ends[x] for x in open_])
        shared = shared[: len(shared) // 4 * 4]
        return stem + shared, firsts, [e[len(shared) :] for e in ends]


@lru_cache(maxsize=2)
def model_of(path: str) -> Model:
    """One model, and its words, for all tasks of a worker."""
    return Model(path)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def entries(matrices: list[np.ndarray]) -> tuple[float, list[np.ndarray]]:
    """Best score through all chunks, and the scores by state with which each is entered: products of halves, then down."""

    def build(lo: int, hi: int) -> np.ndarray:
        middle = (lo + hi) // 2
        tree[lo, hi] = matrices[lo] if hi - lo == 1 else product(build(lo, middle), build(middle, hi))
        return tree[lo, hi]

    def down(lo: int, hi: int, scores: np.ndarray) -> None:
        if hi - lo == 1:
            out.append(scores)
            return
        middle = (lo + hi) // 2
        down(lo, middle, scores)
        down(middle, hi, (scores[:, None] + tree[lo, middle]).max(0))

    tree: dict[tuple[int, int], np.ndarray] = {}
    out: list[np.ndarray] = []
    total = build(0, len(matrices))
    down(0, len(matrices), np.where(np.arange(len(total)) == 0, 0.0, -np.inf))
    return float(total[0, 0]), out


def picked(chunks: list[dict]) -> bytes:
    """The ids of a text from the traces of its chunks, in order."""
    out, state = [], 0
    for chunk in reversed(chunks):
        out += [chunk["ends"][state], chunk["stem"]]
        state = chunk["firsts"][state]
    return b"".join(reversed(out))


_OUT = "doc_id long, n_pieces long, score double, ids_crc32 long, decoded boolean, n_model_pieces long, model_crc32 long"
_TRACE = "stem binary, firsts array<int>, ends array<binary>"


def encoded(docs: DataFrame, path: str, ids: bool = False, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_pieces, score, ids_crc32, whether the ids decode to the text, count and crc32 of the model's own ids.

    With `ids` also the ids as bytes. Of cut texts the decoded one is compared by SHA-256.
    """
    schema = _OUT + ", ids binary" * ids
    texts = texts_of(docs).withColumn("uid", F.expr("uuid()")).where(F.length("text") > chunk)
    short = texts_of(docs).where(F.coalesce(F.length("text"), F.lit(0)) <= chunk)
    names = [f.split()[0] for f in schema.split(", ")]

    def batch_of(*columns: list) -> pa.RecordBatch:
        keys, raw, scores, decoded, own_sizes, own_sums = columns
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
        values = [keys, [len(r) // 4 for r in raw], scores, list(map(zlib.crc32, raw)), decoded, own_sizes, own_sums, raw]
        return pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind, _ in zip(values, kinds, names, strict=False)], names)

    def whole():
        model = model_of(path)

        def work(batch: pa.RecordBatch):
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(np.array([len(t) for t in texts]), PASS_BYTES):
                scores, raw, own = map(list, zip(*model.encode_all(texts[a:b]), strict=True))
                decoded = [model.decode(r) == t for r, t in zip(raw, texts[a:b], strict=True)]
                yield batch_of(keys[a:b], raw, scores, decoded, [len(r) // 4 for r in own], list(map(zlib.crc32, own)))

        return work

    def merge():
        model = model_of(path)

        def work(batch: pa.RecordBatch):
            for i, text in enumerate(batch.column("text").to_pylist()):
                own, one = model.merge(text), batch.slice(i, 1)
                extra = [hashlib.sha256(text.encode()).digest()], [len(own) // 4], [zlib.crc32(own)]
                yield pa.RecordBatch.from_arrays([*one.columns, *map(pa.array, extra)], [*one.schema.names, "sha", *names[5:7]])

        return work

    def cut():
        model = model_of(path)

        def work(batch: pa.RecordBatch):
            for uid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = marked(text)
                out: list[list] = [[], [], [], [], []]
                for k, at in enumerate(range(0, len(text), chunk)):
                    part = text[at : at + chunk + model.longest - 1]
                    for column, value in zip(out, (uid, k, text[max(0, at - 1) : at], part, min(chunk, len(text) - at)), strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["uid", "k", "before", "part", "size"])

        return work

    def weigh():
        model = model_of(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts, sizes, before = (batch.column(n).to_pylist() for n in ("part", "size", "before"))
            got = [model.transfer(p, n, b) for p, n, b in zip(parts, sizes, before, strict=True)]
            own = [pa.array([g[0].tobytes() for g in got], pa.binary()), pa.array([g[1] for g in got], pa.string())]
            own += [pa.array([None if g[2] is None else thin(g[2]) for g in got], pa.binary()), pa.array([g[3] for g in got], pa.string())]
            own += [pa.array([n - len(p) + len(g[3]) for p, n, g in zip(parts, sizes, got, strict=True)], pa.int64())]
            return pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("k"), *own], names)

        def thin(ids: bytes) -> bytes:
            return np.frombuffer(ids, "<u4").astype(model.narrow).tobytes()

        names = ["uid", "k", "matrix", "head", "middle", "rest", "size"]
        return work

    def combine(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("k")
        side = int(np.sqrt(len(own["matrix"].iloc[0]) // 8))
        total, scores = entries([np.frombuffer(m).reshape(side, side) for m in own["matrix"]])
        return pd.DataFrame({"uid": own["uid"], "k": own["k"], "entry": [s.tobytes() for s in scores], "total": total})

    def trace():
        model = model_of(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = (batch.column(n).to_pylist() for n in ("head", "middle", "rest", "size", "entry"))
            got = []
            for head, middle, rest, size, entry in zip(*columns, strict=True):
                wide = None if middle is None else np.frombuffer(middle, model.narrow).astype("<u4").tobytes()
                got.append(model.trace(head, wide, rest, size, np.frombuffer(entry)))
            firsts = pa.array([g[1] for g in got], pa.list_(pa.int32()))
            ends = pa.array([[thin(e) for e in g[2]] for g in got], pa.list_(pa.binary()))
            own = pa.array([thin(g[0]) for g in got], pa.binary()), firsts, ends
            return pa.RecordBatch.from_arrays([*map(batch.column, keys), *own], [*keys, "stem", "firsts", "ends"])

        def thin(ids: bytes) -> bytes:
            return np.frombuffer(ids, "<u4").astype(model.narrow).tobytes()

        keys = ["uid", "k", "total"]
        return work

    def join_up():
        model = model_of(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, shas, totals, sizes, sums = (batch.column(n).to_pylist() for n in ("doc_id", "sha", "total", *names[5:7]))
            narrow = [picked(sorted(parts, key=lambda p: p["k"])) for parts in batch.column("parts").to_pylist()]
            raw = [np.frombuffer(r, model.narrow).astype("<u4").tobytes() for r in narrow]
            decoded = [hashlib.sha256(model.decode(r).encode()).digest() == sha for r, sha in zip(raw, shas, strict=True)]
            return batch_of(keys, raw, totals, decoded, sizes, sums)

        return work

    own = "uid string, doc_id long, text string, sha binary, n_model_pieces long, model_crc32 long"
    rows = stored(arrow_map(texts.select("uid", "doc_id", "text"), own, merge), "pieces-long")
    chunks = arrow_map(rows.select("uid", "text"), "uid string, k long, before string, part string, size long", cut)
    weighed = "uid string, k long, matrix binary, head string, middle binary, rest string, size long"
    weighed = stored(arrow_map(chunks.repartition("uid", "k"), weighed, weigh), "pieces-chunks")
    border = weighed.select("uid", "k", "matrix").groupBy("uid").applyInPandas(combine, "uid string, k long, entry binary, total double")
    traced = arrow_map(weighed.drop("matrix").join(border, ["uid", "k"]), f"uid string, k long, total double, {_TRACE}", trace)
    parts = traced.groupBy("uid").agg(F.first("total").alias("total"), F.collect_list(F.struct("k", "stem", "firsts", "ends")).alias("parts"))
    long = rows.drop("text").join(parts, "uid").drop("uid")
    return arrow_map(short, schema, whole).union(arrow_map(long, schema, join_up))


def decoded(encodings: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids (little-endian bytes)."""

    def make():
        model = model_of(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [model.decode(i or b"") for i in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

        return work

    return arrow_map(encodings.select("doc_id", "ids"), "doc_id long, text string", make)
