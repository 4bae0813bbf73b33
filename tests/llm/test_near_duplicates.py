import random
from collections import Counter

import numpy as np

from fleetmeter.llm import near_duplicates as nd


def bag(text):
    words = (text or "").encode().split()
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(rows):
    """Classes of rows (id, text) by all pairs, named by the smallest id."""
    bags, root = [bag(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "").split() == (rows[j][1] or "").split() or jaccard(bags[i], bags[j]) >= 0.8:
                root[find(i)] = find(j)
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            names[find(i)] = min(names.get(find(i), doc_id), doc_id)
    return sorted(((d, names.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(2)
    texts = []
    for heavy in (1, 9):
        base = [f"w{rng.randrange(400)}" for _ in range(300)] + ["a b c d e f"] * heavy * 6
        texts += [" ".join(base), " ".join(base[:260] + ["z"] * 3 + base[270:]), " ".join(base[:150] + base[-heavy:])]
    raw = [t.encode() for t in texts]
    rows = nd.signatures(len(raw), *nd.bags(raw), registers=4096)
    for i in range(len(raw)):
        for j in range(i):
            assert abs((rows[i] == rows[j]).mean() - jaccard(bag(texts[i]), bag(texts[j]))) < 0.03
    assert (nd.signatures(1, *nd.bags([b""])) == 0).all()
    assert (rows[0] == nd.signatures(1, *nd.bags(raw[:1]), registers=4096)[0]).all()
    one, two = (nd.bags([t])[1:] for t in raw[:2])
    assert nd.similarity(one, two) == jaccard(bag(texts[0]), bag(texts[1]))


def test_equals_brute_force(spark):
    rng = random.Random(4)
    make = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]
    rows, number = [], 0
    for group in range(25):
        base = make(rng.choice([3, 8, 60, 300]))
        for _ in range(rng.choice([1, 2, 12])):
            words = list(base)
            for _ in range(rng.randrange(max(1, len(words) // 60) + 1)):
                words[rng.randrange(len(words))] = f"v{rng.randrange(9)}"
            rows.append((number * 7 % 1000, " ".join(words)))
            number += 1
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, rows[0][1].replace(" ", "\n")), (None, rows[0][1]), (None, "alone"), (2004, "x " * 5000)]
    rows += [(2005, "x " * 4900), (5, rows[1][1]), (5, rows[1][1])]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, node string")
    want = brute(rows)
    assert sorted(((r.doc_id, r.class_id) for r in nd.classes(docs).collect()), key=str) == want
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c in want}
    assert nd.classes(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    root = list(range(500))
    for _ in range(500):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    frame = spark.createDataFrame([(bytes([a // 256, a % 256]), bytes([b // 256, b % 256])) for a, b in links], "a binary, b binary")
    got = {r.node[0] * 256 + r.node[1]: r.root[0] * 256 + r.root[1] for r in nd.components(frame, "a", "b").collect()}
    assert all(got.get(i, i) == root[i] for link in links for i in link)
    assert np.unique(list(got.values())).size <= len(got)


def test_links_that_no_first_hub_sees(spark):
    """Pairs of families whose centres are unlike, joined by one link each, and a chain without a centre."""
    rows, places = [], list(range(5, 395, 10))
    for seed in (0, 3, 7):
        rng = random.Random(seed)
        one = [f"p{seed}.{k}" for k in range(400)]
        two, near_one = list(one), list(one)
        for k, at in enumerate(places[:24]):
            two[at] = f"q{seed}.{k}"
        near_two = list(two)
        for at in places[:8]:
            near_one[at] = two[at]
        for at in places[16:24]:
            near_two[at] = one[at]
        for centre in (one, two):
            rows.append((len(rows), " ".join(centre)))
            for _ in range(20):
                copy = list(centre)
                copy[rng.choice(places) + 4] = f"e{rng.randrange(10**9)}"
                rows.append((len(rows), " ".join(copy)))
        rows += [(len(rows) + k, " ".join(x)) for k, x in enumerate((near_one, near_two))]
    link = [f"c{k}" for k in range(150)]
    for step in range(20):
        link[step * 7 % 150] = link[step * 7 % 150 + 1] = f"c.{step}"
        rows.append((len(rows), " ".join(link)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert len({c for _, c in want}) == 4
    assert sorted(((r.doc_id, r.class_id) for r in nd.classes(docs).collect()), key=str) == want


def test_similar_texts_share_a_rare_token_whatever_the_order():
    rng = np.random.default_rng(3)
    for levels in (np.zeros(1 << nd.LEVEL_BITS, np.uint8), rng.integers(0, 30, 1 << nd.LEVEL_BITS).astype(np.uint8)):
        met = 0
        for _ in range(300):
            words = [f"w{rng.integers(60)}" for _ in range(rng.integers(5, 200))] + ["same few words again now"] * int(rng.integers(0, 4))
            other = list(words)
            for _ in range(rng.integers(0, 5)):
                other[rng.integers(len(other))] = f"v{rng.integers(9)}"
            one, two = " ".join(words), " ".join(other[: len(other) - int(rng.integers(0, 2))])
            if jaccard(bag(one), bag(two)) >= 0.8:
                met += 1
                assert np.intersect1d(nd.prefix(one.encode(), levels)[0], nd.prefix(two.encode(), levels)[0]).size
        assert met > 50


def test_texts_of_one_template_do_not_meet(spark):
    """Two hundred of 270 words in common: pairs grow with the texts and not with their square."""
    many = {}
    for n in (100, 200, 400):
        rng = random.Random(n)
        template = [f"t{k}" for k in range(200)]
        rows = [(bytes([i // 256, i % 256]), " ".join(template + [f"u{rng.randrange(10**9)}" for _ in range(70)]).encode()) for i in range(n)]
        pack = nd.zstandard.ZstdCompressor(level=1).compress
        texts = spark.createDataFrame([(i, pack(t), i) for i, t in rows], "node binary, words binary, root binary")
        many[n] = nd.prefix_pairs(texts).count()
    assert many[400] <= 4 * max(many[100], 25)


def test_rare_tokens_bring_all_similar_texts_together(spark):
    """No pair of 0.8 or more is lost to the order, the sizes or the places of the shared tokens."""
    rng = random.Random(11)
    rows, pack = [], nd.zstandard.ZstdCompressor(level=1).compress
    for family in range(12):
        words = [f"f{family % 5}.{rng.randrange(40)}" for _ in range(rng.randrange(5, 120))]
        for _ in range(7):
            copy = list(words)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(30)}"
            rows.append(" ".join(copy[: len(copy) - rng.randrange(3)] + ["common end of all texts here"] * rng.randrange(2)))
    rows = sorted(set(rows))
    texts = spark.createDataFrame([(bytes([i]), pack(t.encode()), bytes([i])) for i, t in enumerate(rows)], "node binary, words binary, root binary")
    met = {(r.node[0], r.hub[0]) for r in nd.prefix_pairs(texts).collect()}
    bags_of = [bag(t) for t in rows]
    want = {(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if jaccard(bags_of[i], bags_of[j]) >= 0.8}
    assert len(want) > 20 and want <= met
