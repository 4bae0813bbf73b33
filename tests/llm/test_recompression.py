import hashlib
import random

import pytest

from fleetmeter.llm import exchange, recompression


def brute(rows, window):
    """Removed words of (doc_id, text) rows with distinct ids."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[doc_id] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [make(n) for n in (19, 20, 21, 60, 150)]
    rows = []
    for i in range(120):
        words = make(rng.randrange(80))
        for p in rng.sample(passages, 2):
            lo = rng.randrange(len(p) // 3 + 1)
            words += p[lo : len(p) - rng.randrange(len(p) // 3 + 1)] + make(rng.randrange(30))
        rows.append((i * 3, " ".join(words)))
    rows += [(1, rows[0][1]), (500, rows[0][1]), (501, "a " * 300), (502, "a b " * 200), (503, "b " + "a " * 100), (504, "x y z " * 90)]
    rows += [(505, None), (506, ""), (507, "short"), (None, rows[3][1]), (508, " ".join(make(30_000)))]
    rows += [(509, rows[-1][1]), (510, "\u0085 \x1c é ".join(vocabulary)), (511, "\u0085 \x1c é ".join(vocabulary))]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(exchange, "BUCKET", 20_000)
    rows = texts(seed)
    random.Random(seed).shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, block string").repartition(5)
    out = recompression.remove_repeats(docs, texts=True).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out} == brute(rows, 20) and len(out) == len(rows)
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in out)


def test_repeated_rows_and_empty_tables(spark):
    text = " ".join(map(str, range(50)))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in recompression.remove_repeats(docs).collect()) == [(1, 0), (1, 0), (2, 50)]
    assert recompression.remove_repeats(docs.limit(0)).count() == 0
