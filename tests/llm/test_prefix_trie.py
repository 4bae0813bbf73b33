import hashlib
import random
import re
import zlib

from fleetmeter.llm import prefix_trie

COLUMNS = "conv_id long, turn int, role string, text string, conv string, depth int"


def brute(rows):
    """Every prefix as a tuple, in one dictionary."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))

    def symbol(t):
        return hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest()[:16]

    own = {c: [t[2:] for t in sorted(ts, key=lambda t: (t[:2], symbol(t)))] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members = {}
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    children, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        worth = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += worth
            leaves[p[:d]] += children[p] == 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if whole[c] == p)
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], COLUMNS)
    out = prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.numbered(df)))
    assert [f.name for f in out.schema] == [f.split()[0] for f in prefix_trie.NODES.split(", ")]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 16)
    rng = random.Random(4)
    rows = []
    for c in [*range(70), -3, -25, 200, 213, 1 << 40]:  # ids whose base is absent, and negative ones
        for t in range(rng.choice([1, 2, 3, 5, 9, 13])):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(["a b", "c", "d  e\nf"])))
    rows += [(c, t, "user", "the same  words") for c in range(300, 345) for t in range(4)]  # copies, and a common opening
    rows += [(7, None, None, None), (7, 3, "user", "tie"), (7, 3, "bot", "tie"), (7, 3, "bot", "tie"), (None, 1, "user", "x")]
    rows += [(17, t, "user", f"long {t}") for t in range(20, 150)]  # a deep one
    rows += [(20, 99, "", ""), (400, 0, "user", "word " * 5000)]
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_small_tables(spark):
    for rows in (
        [(40, 0, "user", "hello you")],
        [(5, 0, "a", "b")],  # h > 0 and no base: a conversation without turns
        [(40, 0, "a", "b"), (41, 0, "a", "b"), (42, None, None, None)],
    ):
        assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_a_conversation_may_span_many_ranges(spark):
    """A third of all rows in one conversation is still dealt to all tasks, and numbered right."""
    data = [(7 if i % 3 == 0 else i, i, "r", f"{i}") for i in range(3000)]
    df = spark.createDataFrame([(*r, "x", 3) for r in data], COLUMNS).repartition(4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = prefix_trie.numbered(df)
        want = prefix_trie.numbered(spark.createDataFrame([(7, i, "r", f"{i}", "x", 3) for i in range(0, 3000, 3)] + [(7, 7, "r", "7", "x", 3)], COLUMNS))
        hot = sorted(tuple(r) for r in got.where("conv = 7").select("pos", "sym").collect())
        assert hot == sorted(tuple(r) for r in want.select("pos", "sym").collect())
        assert [r[0] for r in hot] == list(range(1, 1002))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
