import hashlib
import random

from fleetmeter.llm import line_dedup


def chunks(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    out, start = [], 0
    for i in range(len(lines)):
        rolled = h[i] + (31 * h[i - 1] if i > 0 else 0) + (961 * h[i - 2] if i > 1 else 0)
        if rolled % line_dedup.DIVISOR == 0 or i == len(lines) - 1:
            out.append(lines[start : i + 1])
            start = i + 1
    return out


def brute(rows):
    places = {}
    for doc_id, text in rows:
        for pos, c in enumerate(chunks(text or "")):
            if len(c) > 1:
                key, here = "\n".join(c), (-1 if doc_id is None else doc_id, pos)
                places[key] = min(places.get(key, here), here)
    out = []
    for doc_id, text in rows:
        own = chunks(text or "")
        stay = [c for pos, c in enumerate(own) if len(c) == 1 or places["\n".join(c)] == (-1 if doc_id is None else doc_id, pos)]
        lines = sum(map(len, own)) * bool(text)
        kept = "\n".join("\n".join(c) for c in stay)
        out.append((doc_id, lines, len(own) * bool(text), sum(map(len, own)) - sum(map(len, stay)), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    rng = random.Random(1)
    make = lambda n: [f"line {rng.randrange(10**6)} é" for _ in range(n)]
    shared = [make(n) for n in (1, 2, 8, 40)]
    rows = [(i * 3, "\n".join(make(rng.randrange(5)) + rng.choice(shared) + make(3) + rng.choice(shared))) for i in range(60)]
    rows += [(1, rows[0][1]), (1, rows[0][1]), (2, None), (4, ""), (5, "\n\n\n\n\n\n\n\n\n"), (None, rows[2][1]), (7, "x\n" * 3000), (8, "x\n" * 3000)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, pos string, _th int")
    assert sorted((tuple(r) for r in line_dedup.summary(docs).collect()), key=str) == brute(rows)
    out = line_dedup.replace_texts(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = sorted(((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in out.collect()), key=str)
    assert got == sorted(((b[0], b[4]) for b in brute(rows)), key=str)
    assert line_dedup.summary(docs.limit(0)).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "InArrow", "Cartesian"))


def test_a_collision_of_hashes_removes_nothing_unequal(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "DIVISOR", 1 << 40)  # one chunk a document
    real = line_dedup.F.xxhash64
    monkeypatch.setattr(line_dedup.F, "xxhash64", lambda c: line_dedup.F.lit(5).cast("long") if c == "chunk" else real(c))
    docs = spark.createDataFrame([(1, "a\nb"), (2, "a\nc"), (3, "a\nb")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in line_dedup.summary(docs).collect()) == [(1, 0), (2, 0), (3, 2)]
