import math
import random

from pyspark.sql import functions as F

from fleetmeter.llm import topk


def brute(rows, every, k):
    whole = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, x in whole:
        if q % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in whole if i != q and len(y) == len(x))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", 16)
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * (i % 3) + rng.gauss(0, 0.2) for _ in range(6)]) for i in range(200)]
    rows += [(200 + i, [0.5] * 6) for i in range(100)]  # equal vectors
    rows += [(400, None), (405, [None] * 6), (410, [math.nan] * 6), (415, [math.inf] * 6), (None, [0.1] * 6)]
    rows += [(420, [1.0, 2.0]), (425, [2.0, 1.0]), (430, []), (435, []), (0, rows[0][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rank string")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("id") % 5 == 0, 5).collect())
    assert got == brute(rows, 5, 5)
    assert topk.top_k(df.limit(0), F.col("id") % 5 == 0).count() == 0
    few = df.where("vec_id in (0, 1, 2)")
    assert topk.top_k(few, F.col("id") % 5 == 0).count() == 2
