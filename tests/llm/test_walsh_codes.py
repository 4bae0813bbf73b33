import hashlib
import math
import random

import numpy as np
import pytest

from fleetmeter.llm import walsh_codes


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """The same codes by plain sums over all entries, in unbounded whole numbers."""
    good = [(i, [math.floor(scale * x) for x in v], c) for i, v, c in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good = [r for r in good if len(r[1]) and len(r[1]) % parts == 0]
    known = sorted((r for r in good if r[0] is not None), key=lambda r: (r[0], r[1]))
    good = [r for r in good if known and len(r[1]) == len(known[0][1])]
    first = {}
    for i, x, _ in known:
        if len(x) == len(known[0][1]):
            first.setdefault(i, x)
    if not first:
        return []
    n = len(known[0][1]) // parts

    def cut(x):
        return [x[p * n : (p + 1) * n] for p in range(parts)]

    seeds = [cut(first[i]) for i in sorted(first)[:entries]]
    books = [[s[p] for s in seeds] for p in range(parts)]

    def assign(x):
        found = [min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p])) for p, part in enumerate(cut(x))]
        return [k for _, k in found], sum(d for d, _ in found)

    for _ in range(rounds):
        coded = [(assign(x)[0], cut(x)) for _, x, _ in good]
        for p in range(parts):
            for k in range(len(seeds)):
                own = [c[p] for code, c in coded if code[p] == k]
                if own:
                    books[p][k] = [sum(v) // len(own) for v in zip(*own)]
    sha = hashlib.sha256(",".join(str(v) for p in books for e in p for v in e).encode()).hexdigest()
    out = [(i, *assign(x), c) for i, x, c in good]
    by = {}
    for _, _, e, c in out:
        by[c] = by.get(c, 0) + e
    return sorted(((i, "".join(f"{k:02x}" for k in code), e, by[c], sha) for i, code, e, c in out), key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, v, c, "x", 1) for i, v, c in rows], "vec_id long, embedding array<float>, label int, x string, id int")


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def single(x):
    return [float(np.float32(v)) for v in x]


def test_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, single(rng.gauss(0, 0.3) for _ in range(24)), rng.choice([None, 1, 2])) for i in range(120)]
    rows += [(500 + i, rows[3][1], 7) for i in range(40)]  # copies, and ties between entries
    rows += [(3, rows[3][1], 7), (3, rows[4][1], 7), (None, rows[9][1], None), (2, single([-1.0] * 24), 9)]
    rows += [(700, None, 1), (701, [None] * 24, 1), (702, [math.nan] + [0.0] * 23, 1), (703, [math.inf] * 24, 1)]
    rows += [(704, [0.5] * 7, 1), (705, [], 1), (706, [0.5] * 16, 1)]  # other lengths
    got = found(walsh_codes.compress(table(spark, rows)))
    assert got == brute(rows) and len(got) == 164


def test_few_rows_and_none(spark):
    rows = [(5, single([0.1 * j for j in range(8)]), None), (9, single([0.3] * 8), 1)]
    assert found(walsh_codes.compress(table(spark, rows))) == brute(rows)
    assert walsh_codes.compress(table(spark, rows).limit(0)).count() == 0
    assert walsh_codes.compress(table(spark, [(None, single([0.5] * 8), 1)])).count() == 0
    with pytest.raises(ValueError, match="too large"):
        walsh_codes.compress(table(spark, [(1, [1e30] * 8, 1)]))


def test_transform_keeps_scaled_distances_and_orders_by_sequency():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 5, 8, 13):
        x, y = rng.integers(-(1 << 20), 1 << 20, (2, 9, n))
        size = walsh_codes.padded(n)
        a, b = walsh_codes.transformed(x), walsh_codes.transformed(y)
        assert a.shape == (9, size)
        assert (((a - b) ** 2).sum(1) == size * ((x - y) ** 2).sum(1)).all()
    walsh = walsh_codes.transformed(np.eye(16, dtype=np.int64)).T
    assert [int((np.diff(w) != 0).sum()) for w in walsh] == list(range(16))


def test_entries_are_eliminated_early_and_ties_go_to_the_lower_index():
    rng = np.random.default_rng(2)
    smooth = np.cumsum(rng.integers(-50, 51, (2000, 32)), 1) * 10
    x, e = walsh_codes.transformed(smooth), walsh_codes.transformed(np.concatenate([smooth[:15], smooth[:1]]))
    best, scaled, work = walsh_codes.nearest(x, e)
    whole = ((x[:, None] - e[None]) ** 2).sum(2)
    assert (best == whole.argmin(1)).all() and (scaled == whole.min(1)).all() and best[0] == 0
    assert work < whole.size * 32 / 2
