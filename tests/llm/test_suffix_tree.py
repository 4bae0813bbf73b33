import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fleetmeter.llm import suffix_tree as st
from fleetmeter.llm.queries import QUERIES

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def test_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    out = {r.doc_id: r for r in QUERIES["op6_lm_scoring"](spark, sf).collect()}
    counts = Counter()
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            counts.update([*WORD.findall(r.text.encode().lower()), None])
    n, v = sum(counts.values()), len(counts)
    assert len(out) == len(rows)
    for r in rows:
        tokens = [*WORD.findall(r.text.encode().lower()), None]
        got = out[r.doc_id]
        assert got.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert (got.n_tokens, got.n_known, got.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert got.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), rel=1e-9)
    seen = [r for r in out.values() if not r.held_out]
    assert sum(r.score for r in seen) > sum(r.base_score for r in seen)
    # held out, where words are new, a byte costs far less than without a model
    size = {r.doc_id: len(r.text.encode()) for r in rows}
    held = [r for r in out.values() if r.held_out]
    assert sum(r.score for r in held) > -0.9 * sum(size[r.doc_id] for r in held)


def walk(text, table, depth, frequent):
    """log10 probability by looking up the longest kept suffix anew for each symbol."""

    def chance(context, symbol):
        counts = table.get(context, {})
        size = sum(counts.values())
        if not context:
            return (counts.get(symbol, 0) + 1) / (size + st.FOLLOW)
        return (counts.get(symbol, 0) + st.PRIOR * chance(context[1:], symbol)) / (size + st.PRIOR)

    def gain(symbol):
        context = tuple(past[-depth:])
        while context not in table:
            context = context[1:]
        return math.log10(chance(context, symbol))

    past, total = [0] * depth, 0.0
    for word in text.lower().split():
        if word in frequent:
            total += gain(frequent[word])
        for b in word + b" ":
            total += 0 if word in frequent else gain(b + 1)
            past.append(b + 1)
    return total + gain(0)


def test_automaton_equals_lookup(spark):
    texts = ["the cat and the hat", "the bat", "a cat sat on the mat " * 30, "", "THE END", "öde\n zzz"]
    frequent = [b"the", b"cat", b"on", b"never"]
    keys = st.word_keys(frequent)
    grams = st.count_grams(spark.createDataFrame([(t,) for t in texts], "text string"), keys, 3)
    rows = st.kept_contexts(grams, 3, share=0.002, divergence=0.01).collect()
    table = {}
    for r in rows:
        context, value = [], r.context
        for _ in range(r.k):
            context.insert(0, value % st.SYMBOLS)
            value //= st.SYMBOLS
        table.setdefault(tuple(context), {})[r.symbol] = r.n
    assert any(len(c) == 3 for c in table) and () in table
    arrays = {c: np.array([r[c] for r in rows], np.int64) for c in ("k", "context", "symbol", "n")}
    model = st.Automaton({**arrays, "words": np.array(frequent, object)}, keys, 3)
    numbers = {w: st.SYMBOLS + int(np.searchsorted(keys, st.word_keys([w])[0])) for w in frequent}
    asked = [t.encode() for t in texts] + [b"zzz \x01", b"the cat " * 200, b"never on  the\n\n"]
    total, spelled, spelling = model.score(asked)
    at = 0
    for text, score in zip(asked, total, strict=True):
        size = len(text.split())
        assert score + spelling[at : at + size].sum() == pytest.approx(walk(text, table, 3, numbers), rel=1e-5)
        assert spelled[at : at + size].tolist() == [w not in frequent for w in text.lower().split()]
        at += size
    assert (spelling <= 1e-6).all()
    # the choice to spell, the frequent words and the end make up everything that can follow
    start = model.gain.reshape(-1, model.width)[0]
    seen = len(np.unique(arrays["symbol"]))
    frequent_seen = [model.column[numbers[w]] for w in frequent if model.column[numbers[w]] < seen]
    rest = 10 ** start[[model.column[0], *frequent_seen]].astype(float)
    hidden = (st.WORDS - len(frequent_seen)) * 10 ** float(start[-2])
    assert 10 ** model.escape[0] + rest.sum() + hidden == pytest.approx(1, rel=1e-4)


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (2, "", 1), (None, "word word", 1), (3, "x " * 50_000, 1), (4, "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    out = st.scored(docs).collect()
    assert len(out) == len(rows) and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in out)
    assert st.scored(docs.limit(0)).count() == 0
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    alone = st.scored(docs.sparkSession.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert [(r.train_tokens, r.n_known) for r in alone] == [(0, 0)] * 2


def test_grams_are_counted_in_parts_and_scores_take_split_words(spark, monkeypatch):
    monkeypatch.setattr(st, "COUNTED", 50)  # the tasks of a local session get it with the function
    texts = ["the cat and the hat", "a Cat sat on the mat " * 5, "", "öde\n zzz"]
    keys = st.word_keys([b"the", b"cat"])
    depth, want = 2, Counter()
    for text in texts:
        past = [0] * depth
        for word in text.lower().encode().split():
            known = np.flatnonzero(keys == st.word_keys([word])[0])
            follows = [st.SYMBOLS + int(known[0])] + [None] * len(word) if len(known) else [b + 1 for b in word + b" "]
            for b, follow in zip(word + b" ", follows, strict=True):
                if follow is not None:
                    want[(past[-2] * st.SYMBOLS + past[-1]) * st.FOLLOW + follow] += 1
                past.append(b + 1)
        want[(past[-2] * st.SYMBOLS + past[-1]) * st.FOLLOW] += 1
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r.gram: r.n for r in st.count_grams(rows, keys, depth).collect()} == want
    arrays = {"k": np.zeros(3, np.int64), "context": np.zeros(3, np.int64), "symbol": np.array([0, 33, st.SYMBOLS]), "n": np.array([1, 5, 9])}
    model = st.Automaton({**arrays, "words": np.array([b"the"], object)}, keys, depth)
    asked = [t.encode() for t in [*texts, "x" * 700]]
    for one, other in zip(model.score(asked), model.score_words(st.split(asked)), strict=True):
        assert one.tolist() == other.tolist()
