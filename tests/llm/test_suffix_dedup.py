import hashlib
import random

import numpy as np
import pytest

from fleetmeter.llm import exchange, suffix_dedup


def brute(rows, window):
    """Removed bytes of (doc_id, text) rows."""
    least = {}
    for doc_id, text in rows:
        raw, key = (text or "").encode(), -1 if doc_id is None else doc_id
        for s in range(len(raw) - window + 1):
            w = raw[s : s + window]
            least[w] = min(least.get(w, key), key)
    out = []
    for doc_id, text in rows:
        raw, key = (text or "").encode(), -1 if doc_id is None else doc_id
        gone = [False] * len(raw)
        for s in range(len(raw) - window + 1):
            if least[raw[s : s + window]] < key:
                gone[s : s + window] = [True] * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(seed):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passages = [make(n) for n in (30, 45, 49, 50, 51, 120, 900)]
    rows = []
    for i in range(100):
        text = make(rng.randrange(150))
        for p in rng.sample(passages, 2):
            lo = rng.randrange(len(p) // 4)
            text += p[lo : len(p) - rng.randrange(len(p) // 4 + 1)] + make(rng.randrange(60))
        rows.append((i * 3, text))
    rows += [(1, rows[0][1]), (500, rows[0][1]), (501, "a" * 400), (502, "ab" * 200), (503, "b" + "a" * 300), (504, None), (505, "")]
    rows += [(506, "x"), (None, rows[4][1]), (507, make(40_000))]
    rows += [(508, rows[-1][1][:20_000] + make(10) + rows[-1][1][20_000:]), (510, rows[5][1]), (510, rows[5][1]), (510, rows[6][1] + rows[5][1])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(exchange, "BUCKET", 20_000)
    rows = texts(seed)
    random.Random(seed).shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, block string").repartition(5)
    out = suffix_dedup.remove_copies(docs, texts=True).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out), key=str) == brute(rows, 50)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in out)
    assert suffix_dedup.remove_copies(docs.limit(0)).count() == 0


def test_longest_previous_factors():
    rng = np.random.default_rng(5)
    for many, letters, docs in ((0, [97], 1), (1, [97], 1), (40, [97], 9), (200, [0, 97, 255], 60), (300, [0, 1], 300), (300, [97, 98], 2)):
        strings = rng.choice(np.array(letters, np.uint8), (many, 7))
        doc = rng.integers(0, docs, many)
        want = []
        for x, d in zip(strings, doc, strict=True):
            starts = [np.append(np.flatnonzero(x != y), 7)[0] for y, e in zip(strings, doc, strict=True) if e < d]
            want.append(max(starts, default=0))
        assert suffix_dedup.longest_previous(strings, doc).tolist() == want
    falling = np.zeros((5000, 7), np.uint8)  # equal strings, each document smaller than the one before
    assert suffix_dedup.longest_previous(falling, np.arange(5000)[::-1]).tolist() == [7] * 4999 + [0]


def test_strings_that_others_have_are_never_left_out():
    rng = np.random.default_rng(6)
    data = rng.integers(0, 3, 4000).astype(np.uint8)
    place = np.sort(rng.choice(3990, 2000, replace=False))
    strings = [data[p : p + 9].tobytes() for p in place]
    want = [i for i, x in enumerate(strings) if strings.count(x) > 1]
    assert suffix_dedup.repeated(data, place, 9).tolist() == want


def test_sliding_least():
    values = np.random.default_rng(7).integers(0, 1000, 300).astype(np.uint64)
    for width in (1, 2, 3, 16, 27):
        assert suffix_dedup.sliding_least(values, width).tolist() == [min(values[i : i + width]) for i in range(300 - width + 1)]
