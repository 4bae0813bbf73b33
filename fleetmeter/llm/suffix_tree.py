"""Language-model scores from a probabilistic suffix tree, beside a word model.

The tree predicts a document word by word (A-Z lower-cased): a frequent word is one symbol, any other is spelled byte by
byte up to its end, and an end symbol closes the document. The context of a symbol is the text before it, words joined
by one blank. Contexts of up to `DEPTH` bytes are counted over every training document. One stays if its share of all
symbols is at least `SHARE` and the distribution after it differs from that after its longest proper suffix (divergence
of at least `DIVERGENCE` nats). So the tree has at most DEPTH / SHARE contexts, whatever the input. Distributions are
smoothed along the suffixes, down to one over all symbols. The tree becomes an automaton whose state is the longest
kept suffix; because a state depends on the last `DEPTH` bytes alone, long texts are cut into strips that are scored
side by side.

A spelled word that training knows is more likely than its spelling: after the choice to spell, the word w has
probability (c + T * spelling) / (n + T), where n tokens and T different words of training are spelled.

The word model counts words over the same documents. Words with a share of `HEAVY` or more (at most 1 / HEAVY of them)
travel to every task; all others meet their counts in a join, where none of them is frequent.

A null text is empty: it holds only its end. An empty table gives no rows. Without training documents every symbol
is equally likely. Rows that repeat are scored each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm.common import PASS_BYTES, arrow_map, slices, stored, text_bytes, words_of
from fleetmeter.llm.language import held_out

DEPTH = 5
SHARE = 5e-5
DIVERGENCE = 0.02
#: Pseudo-observations that a context takes over from its suffix.
PRIOR = 30.0
HEAVY = 4e-6
#: Frequent words that are symbols of their own.
WORDS = 1000
#: Symbols of a context: the end, and each byte plus one. What follows may also be SYMBOLS + a frequent word's number.
SYMBOLS = 257
FOLLOW = SYMBOLS + WORDS
STRIP = 256
#: Words that a task holds before it hands them on.
HELD = 200_000
#: Grams that a task counts at a time.
COUNTED = 2_000_000
#: Context symbol of a byte.
_SYMBOL = np.where(np.arange(256) == 10, 0, np.arange(1, 257)).astype(np.int16)


def word_keys(words: list[bytes]) -> np.ndarray:
    """Sorted hashes of the frequent words."""
    return np.sort(words_of(np.frombuffer(b" ".join(words), np.uint8))[2])


def split(texts: list[bytes]) -> list[list[bytes]]:
    """The words of each text, A-Z lower-cased."""
    return [t.lower().split() for t in texts]


def _stream(texts: list[list[bytes]], depth: int, keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Context symbols of the texts (their words), `depth` ends before each and one after; what is predicted at each place
    (-1 for nothing, inside a frequent word); where texts begin, and their sizes; begin and end of each word."""
    plain = [b" ".join([*words, b""]) for words in texts]
    between = b"\n" * (depth + 1)
    raw = np.frombuffer(b"\n" * depth + between.join(plain) + b"\n", np.uint8) if plain else np.empty(0, np.uint8)
    symbols = _SYMBOL[raw]
    sizes = np.array([len(p) + 1 for p in plain], np.int64)
    starts = np.cumsum(sizes + depth) - sizes
    follow = symbols.copy()
    first, last, hashes = words_of(raw)
    if len(keys) and len(hashes):
        place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        known = keys[place] == hashes
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[first[known] + 1] = 1  # words lie apart: no place is set twice
        inside[last[known] + 1] = -1
        follow[np.cumsum(inside, dtype=np.int8)[: len(raw)] > 0] = -1
        follow[first[known]] = SYMBOLS + place[known]
    for k in range(1, depth + 1):
        follow[starts - k] = -1
    return symbols, follow, starts, sizes, first, last


def _grams(texts: list[bytes], depth: int, keys: np.ndarray) -> np.ndarray:
    """Every predicted symbol with the `depth` before it as one number."""
    symbols, follow, *_ = _stream(split(texts), depth, keys)
    place = np.flatnonzero(follow >= 0)
    gram = np.zeros(len(place), np.int64)
    for k in range(depth, 0, -1):
        gram *= SYMBOLS
        gram += symbols[place - k]
    gram *= FOLLOW
    gram += follow[place]
    return gram


def count_grams(texts: DataFrame, keys: np.ndarray, depth: int = DEPTH) -> DataFrame:
    """gram and n over all texts (the only column); each task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def send() -> pa.RecordBatch:
            grams, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n.astype(np.int64))], ["gram", "n"])

        for batch in batches:
            texts = text_bytes(batch.column(0))
            for a, b in slices(np.array([len(t) for t in texts])):
                held.append(_grams(texts[a:b], depth, keys))
                if sum(len(grams) for grams in held) > COUNTED:
                    yield send()
        if held:
            yield send()

    return texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def kept_contexts(grams: DataFrame, depth: int = DEPTH, share: float = SHARE, divergence: float = DIVERGENCE) -> DataFrame:
    """k, context, symbol, n of the contexts that stay."""
    total = grams.agg(F.sum("n")).first()[0] or 0
    cut = F.element_at(F.array(*(F.lit(SYMBOLS**k) for k in range(depth + 1))), F.col("k") + 1)
    levels = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("k")
    level = grams.select(levels, (F.col("gram") % FOLLOW).alias("symbol"), F.expr(f"gram div {FOLLOW}").alias("whole"), "n")
    level = level.withColumn("context", F.col("whole") % cut).groupBy("k", "context", "symbol").agg(F.sum("n").alias("n"))
    level = stored(level, "suffix-levels")
    sizes = level.groupBy("k", "context").agg(F.sum("n").alias("size")).where(F.col("size") >= share * total)
    big = stored(level.join(sizes, ["k", "context"]), "suffix-contexts")
    below = F.element_at(F.array(*(F.lit(SYMBOLS ** max(0, k - 1)) for k in range(depth + 1))), F.col("k") + 1)
    parent = big.select((F.col("k") + 1).alias("k"), F.col("context").alias("suffix"), "symbol", F.col("n").alias("n_up"), F.col("size").alias("size_up"))
    pairs = big.withColumn("suffix", F.col("context") % below).join(parent, ["k", "suffix", "symbol"])
    own, up = F.col("n") / F.col("size"), F.col("n_up") / F.col("size_up")
    apart = pairs.groupBy("k", "context").agg(F.sum(own * F.log(own / up)).alias("apart")).where(F.col("apart") >= divergence)
    chosen = apart.select("k", "context").union(sizes.where("k = 0").select("k", "context"))
    # the automaton needs every suffix of a kept context
    closure = chosen.select(F.explode(F.sequence(F.lit(0), F.col("k"))).alias("k"), "context")
    closure = closure.select("k", (F.col("context") % cut).alias("context")).distinct()
    return big.join(closure, ["k", "context"]).select("k", "context", "symbol", "n")


class Automaton:
    """States are the kept contexts and their prefixes. step[state, byte] is the next state, gain[state, symbol] a log10 probability."""

    def __init__(self, rows: dict[str, np.ndarray], keys: np.ndarray, depth: int = DEPTH):
        k, context, symbol, n = (rows[c] for c in ("k", "context", "symbol", "n"))
        self.depth, self.keys = depth, keys
        seen = np.unique(symbol)
        self.column = np.full(FOLLOW + 1, len(seen), np.int32)  # symbols never seen share a column
        self.column[seen] = np.arange(len(seen))
        self.column[-1] = len(seen) + 1  # nothing is predicted
        self.width = len(seen) + 2
        signs = np.unique(np.concatenate([seen[seen < SYMBOLS], [0, 33]]).astype(np.int64))
        spelled = np.frombuffer(b"".join(rows["words"].tolist()), np.uint8).astype(np.int64) + 1
        signs = np.union1d(signs, spelled)
        self.sign = np.full(SYMBOLS, len(signs), np.int32)
        self.sign[signs] = np.arange(len(signs))
        self.signs = len(signs) + 1
        levels = [np.unique(context[k == j]) for j in range(depth + 1)]
        for j in range(depth, 0, -1):  # a state is reached through its prefixes, and falls back to its suffixes
            levels[j - 1] = np.unique(np.concatenate([levels[j - 1], levels[j] // SYMBOLS, levels[j] % SYMBOLS ** (j - 1)]))
        if not len(levels[0]):
            levels[0] = np.zeros(1, np.int64)
        first = np.cumsum([0] + [len(x) for x in levels])
        chance = np.ones((first[-1], self.width), np.float32)
        step = np.zeros((first[-1], self.signs), np.int32)
        for j, own in enumerate(levels):
            if not len(own):
                continue
            counts = np.zeros((len(own), self.width - 1), np.float32)
            pick = k == j
            np.add.at(counts, (np.searchsorted(own, context[pick]), self.column[symbol[pick]]), n[pick])
            size = counts.sum(1, keepdims=True)
            if j == 0:
                chance[0, :-1] = (counts[0] + 1) / (size[0] + FOLLOW)
            else:
                up = first[j - 1] + np.searchsorted(levels[j - 1], own % SYMBOLS ** (j - 1))
                chance[first[j] : first[j + 1], :-1] = (counts + PRIOR * chance[up, :-1]) / (size + PRIOR)
            after = own[:, None] * SYMBOLS + signs[None, :]
            target = np.zeros(after.shape, np.int32)
            for m in range(min(j + 1, depth), 0, -1):  # the longest suffix that is a state
                if len(levels[m]):
                    value = after % SYMBOLS**m
                    place = np.minimum(np.searchsorted(levels[m], value), len(levels[m]) - 1)
                    hit = (target == 0) & (levels[m][place] == value)
                    target[hit] = first[m] + place[hit]
            step[first[j] : first[j + 1], :-1] = target
        self.step = (step * self.signs).ravel()  # a state stands there as its first place in this table
        spells = np.isin(np.arange(self.width), self.column[1:SYMBOLS][np.isin(np.arange(1, SYMBOLS), seen)])
        # the shared column stands for each symbol never seen; the bytes among them may begin a word too
        unseen = SYMBOLS - 1 - np.isin(np.arange(1, SYMBOLS), seen).sum()
        self.escape = np.log10(chance[:, spells].sum(1, dtype=np.float64) + unseen * chance[:, -2])
        self.gain = np.log10(chance, out=chance).ravel()

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text, the log10 probability of its frequent words, its choices to spell and its end; for each word
        (all texts in order), whether it is spelled and the log10 probability of its spelling."""
        return self.score_words(split(texts))

    def score_words(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for the words of each text."""
        symbols, follow, starts, sizes, first, last = _stream(texts, self.depth, self.keys)
        many = -(-sizes // STRIP)
        owner = np.repeat(np.arange(len(texts)), many)
        offset = (np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)) * STRIP
        begin, length = starts[owner] + offset, np.minimum(STRIP, sizes[owner] - offset)
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        rows = int(length[0])
        live = np.searchsorted(-length, -np.arange(rows), "left")  # strips that reach a row
        live[0] = len(begin)
        states, state = np.zeros(len(symbols), np.int32), np.zeros(len(begin), np.int32)
        signs = self.sign[symbols]
        for j in range(-self.depth, rows):
            if j > 0:
                state, begin = state[: live[j]], begin[: live[j]]
            place = begin + j
            if j >= 0:
                states[place] = state
            state = self.step[state + signs[place]]
        pick = np.flatnonzero(follow >= 0)
        gains = np.zeros(len(symbols))
        gains[pick] = self.gain[states[pick] // self.signs * self.width + self.column[follow[pick]]]
        spelled = follow[first] < SYMBOLS
        sums = np.concatenate([[0.0], np.cumsum(gains)])
        escape = self.escape[states[first] // self.signs]
        spelling = np.where(spelled, sums[last + 1] - sums[first] - escape, 0.0)
        text = np.searchsorted(starts, first, "right") - 1
        total = sums[starts + sizes] - sums[starts] - np.bincount(text, spelling, len(texts))
        return total, spelled, spelling


def learn(training: DataFrame, frequent: list[bytes], depth: int = DEPTH) -> Automaton:
    """The automaton of the texts of `training`."""
    keys = word_keys(frequent)
    grams = stored(count_grams(training.select("text"), keys, depth), "suffix-grams")
    found = kept_contexts(grams, depth).toArrow()
    rows = {c: found.column(c).to_numpy().astype(np.int64) for c in ("k", "context", "symbol", "n")}
    return Automaton({**rows, "words": np.array(frequent, object)}, keys, depth)


def count_words(texts: DataFrame) -> DataFrame:
    """word (bytes) and c over all texts, the end left out; each task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def send() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "c"])

        for batch in batches:
            for text in text_bytes(batch.column(0)):
                held.update(text.lower().split())
                if len(held) > HELD:
                    yield send()
                    held.clear()
        if held:
            yield send()

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def scored(docs: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; trained outside the held-out fold."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("held_out", held_out(folds, fold))
    training = rows.where(~F.col("held_out")).select("text")
    words = stored(count_words(training), "suffix-words")
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = training.count()
    total, distinct = sums["n"] + ends, sums["v"] + (ends > 0)
    base = math.log10(total + distinct + 1)
    top = words.orderBy(F.desc("c"), "word").limit(WORDS).collect()
    automaton = spark.sparkContext.broadcast(learn(training, [bytes(r["word"]) for r in top]))
    spelled_words = float(sums["v"] - len(top))
    spelled_tokens = float(sums["n"] - sum(r["c"] for r in top))
    heavy_rows = words.where(F.col("c") >= max(1.0, HEAVY * total)).toArrow()
    heavy = spark.sparkContext.broadcast(dict(zip(heavy_rows.column(0).to_pylist(), heavy_rows.column(1).to_pylist(), strict=True)))
    new_words = max(spelled_words, 1.0)
    spell_base = math.log10(spelled_tokens + new_words)

    def make():
        model, counts = automaton.value, heavy.value
        part, row = TaskContext.get().partitionId() << 40, 0
        end = (math.log10(ends + 1) - base, int(ends > 0))

        def work(batch: pa.RecordBatch):
            nonlocal row
            texts = text_bytes(batch.column(1))
            for a, b in slices(np.array([len(t) for t in texts]), PASS_BYTES):
                own = split(texts[a:b])
                sizes = np.array([len(w) for w in own])
                owner = np.repeat(np.arange(b - a), sizes)
                words = list(chain.from_iterable(own))
                many = np.fromiter(map(counts.get, words, repeat(-1)), np.float64, len(words))
                score, spelled, spelling = model.score_words(own)
                sure = many >= 0
                gain = np.where(spelled & sure, np.log10(many.clip(0) + new_words * 10**spelling) - spell_base, 0.0)
                score = score + np.bincount(owner, gain, b - a)
                logs = np.where(sure, np.log10(many.clip(0) + 1) - base, 0.0)
                uid = np.arange(row, row + b - a) + part
                row += b - a
                arrays = [pa.array(uid), batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(sizes + 1)]
                arrays += [pa.array(np.bincount(owner, sure, b - a).astype(np.int64) + end[1])]
                arrays += [pa.array(np.bincount(owner, logs, b - a) + end[0]), pa.array(score)]
                rest = np.flatnonzero(~sure)
                cuts = np.concatenate([[0], np.cumsum(np.bincount(owner[rest], minlength=b - a))])
                pairs = [pa.array([words[i] for i in rest], pa.binary()), pa.array(spelling[rest], pa.float32())]
                pairs = pa.StructArray.from_arrays(pairs, ["word", "spelling"])
                arrays.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pairs))
                yield pa.RecordBatch.from_arrays(arrays, columns)

        return work

    columns = ["uid", "doc_id", "held_out", "n_tokens", "n_sure", "base_sure", "score_sure", "rare"]
    schema = (
        "uid long, doc_id long, held_out boolean, n_tokens long, n_sure long, base_sure double, score_sure double, "
        "rare array<struct<word: binary, spelling: float>>"
    )
    halves = stored(arrow_map(rows.select("doc_id", "text", "held_out"), schema, make), "suffix-scores")
    rare = halves.select("uid", F.inline("rare")).join(words, "word", "left")
    c = F.coalesce(F.col("c"), F.lit(0))
    spelt = F.log10(c + new_words * F.pow(F.lit(10.0), F.col("spelling").cast("double"))) - spell_base
    rare = rare.groupBy("uid").agg(
        F.count("c").alias("n_rare"), F.sum(F.log10(c + 1) - base).alias("base_rare"), F.sum(spelt).alias("score_rare")
    )
    out = halves.drop("rare").join(rare, "uid", "left")
    added = {n: F.coalesce(n, F.lit(0.0)) for n in ("base_rare", "score_rare")}
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_sure") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_sure") + added["base_rare"]).alias("base_score"),
        (F.col("score_sure") + added["score_rare"]).alias("score"),
    )
