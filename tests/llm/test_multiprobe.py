import math

import numpy as np
from pyspark.sql import functions as F

from fleetmeter.llm import multiprobe


def brute(rows, every, k):
    whole = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q, x in whole:
        if q % every == 0:
            own = np.array([i for i, y in whole if i != q and len(y) == len(x)], np.int64)
            near = np.array([y for i, y in whole if i != q and len(y) == len(x)], float).reshape(-1, len(x))
            score = multiprobe.scores(np.repeat(np.array([x]), len(near), 0), near)
            order = np.lexsort((own, -score))[:k]
            out += [(q, rank, int(own[i]), float(score[i])) for rank, i in enumerate(order, 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "y") for i, v in rows], "vec_id long, embedding array<double>, rank int, x string")


def found(df):
    return sorted(tuple(r) for r in df.collect())


def recall(got, want):
    have = {(r[0], r[2]) for r in got}
    return sum((r[0], r[2]) in have for r in want) / len(want)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(multiprobe, "SHARE", 16)
    monkeypatch.setattr(multiprobe, "ASKED", 4)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 6).tolist()) for i in range(150)]
    rows += [(200 + i, [0.5] * 6) for i in range(100)]  # equal vectors: ties go to the smaller id
    rows += [(400, None), (405, [None] * 6), (410, [math.nan] * 6), (415, [math.inf] * 6), (None, [0.1] * 6), (425, [0.0] * 6)]
    rows += [(420, [1.0, 2.0]), (430, [2.0, 1.0]), (440, []), (0, rows[0][1]), (5, rows[6][1])]
    got = found(multiprobe.search(table(spark, rows), F.col("id") % 5 == 0, 7, found=0.999999))
    want = brute(rows, 5, 7)
    assert {r[0] for r in got} == {r[0] for r in want} and len(got) == len(want)
    assert recall(got, want) > 0.99
    assert {(q, i, s) for q, _, i, s in got} <= {(q, i, s) for q, _, i, s in brute(rows, 5, 10**6)}
    hot = [r for r in want if r[0] == 200]
    assert [r for r in got if r[0] == 200] == hot and [r[2] for r in hot][-1] < 210
    assert multiprobe.search(table(spark, rows).limit(0), F.col("id") % 5 == 0).count() == 0


def test_few_vectors_are_all_found(spark):
    rows = [(i, [float(i), 1.0, -float(i * i)]) for i in range(9)]
    assert found(multiprobe.search(table(spark, rows), F.col("id") % 2 == 0, 20)) == brute(rows, 2, 20)
    assert multiprobe.search(table(spark, rows[:1]), F.col("id") % 2 == 0, 20).count() == 0


def test_recall_on_vectors_with_and_without_clusters(spark):
    rng = np.random.default_rng(7)
    middles = rng.normal(0, 1, (40, 24))
    clustered = middles[rng.integers(0, 40, 3000)] + rng.normal(0, 0.25, (3000, 24))
    for x in (clustered, rng.normal(0, 1, (2000, 24))):
        rows = [(i, v.tolist()) for i, v in enumerate(x)]
        got = found(multiprobe.search(table(spark, rows), F.col("id") % 20 == 0, 20))
        assert recall(got, brute(rows, 20, 20)) >= 0.9


def visited(x, n=60):
    """Share of the vectors in the buckets that a query visits, on average, in one table."""
    model = multiprobe.Tables(x[:: max(1, len(x) // multiprobe.SAMPLE)], len(x), x.shape[1])
    total = 0
    for q in x[:n]:
        for t, keys in enumerate(model.probes(q, 20, 0.95)):
            total += np.isin(model.keys(t, x), keys).mean()
    return total / n / model.tables


def test_probes_follow_the_neighbours(spark):
    """Where neighbours are near, a query visits few buckets; where nothing is near, most."""
    rng = np.random.default_rng(9)
    middles = rng.normal(0, 1, (200, 32))
    near = middles[rng.integers(0, 200, 8000)] + rng.normal(0, 0.1, (8000, 32))
    assert visited(near) < 0.12
    assert visited(rng.normal(0, 1, (8000, 32))) > 0.3


def test_combinations_come_by_falling_chance():
    rng = np.random.default_rng(1)
    chances = [rng.dirichlet(np.ones(n)) for n in (3, 1, 4, 2)]
    keys = [(np.arange(n, dtype=np.uint64) + 1) * np.uint64(10**j) for j, n in enumerate((3, 1, 4, 2))]
    whole = sorted(
        ((a * b * c * d, int(w + x + y + z)) for a, w in zip(chances[0], keys[0]) for b, x in zip(chances[1], keys[1])
         for c, y in zip(chances[2], keys[2]) for d, z in zip(chances[3], keys[3])),
        reverse=True,
    )
    for owed in (0.01, 0.5, 0.9, 0.999999):
        p, k = multiprobe.likeliest(chances, keys, owed)
        assert k.tolist() == [w for _, w in whole[: len(k)]]
        assert p.sum() >= owed - 1e-12 and p[:-1].sum() < owed


def test_a_cell_holds_few_places_and_loses_none(monkeypatch):
    rng = np.random.default_rng(5)
    value, k = np.round(rng.normal(0, 1, (6, 4000)), 2), 7  # with ties
    value[0, ::2] = -np.inf
    held, most = multiprobe._Held(np.full(6, 1e-9), k), 0
    for s in range(0, 4000, 20):
        held.add(np.arange(6), s, value[:, s : s + 20].copy())
        most = max(most, sum(len(r) for r in held.rows))
    r, c = held.best()
    for q in range(6):
        edge = np.sort(value[q])[-k]
        assert set(np.flatnonzero(value[q] >= edge)) <= set(c[r == q])
    assert most < 6 * 4000 / 10 and np.isfinite(value[r, c]).all()


def test_results_merge_without_comparing_each_with_each(spark):
    rng = np.random.default_rng(6)
    cells = []
    for _ in range(40):
        ids = rng.choice(60, 9, replace=False)
        order = np.lexsort((ids, -(ids % 7)))
        cells.append((1, 1, ids[order].tolist(), (ids[order] % 7).astype(float).tolist()))
    met = spark.createDataFrame(cells, "query_id long, row long, ids array<long>, scores array<double>")
    merged = multiprobe._merged(met, 9)
    every = sorted({(-s, i) for _, _, ids, scores in cells for i, s in zip(ids, scores, strict=True)})
    assert [tuple(x) for x in merged.first().best] == every[:9]
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct" not in plan and plan.count("sort_array") == 2
