import re
from collections import Counter

from fleetmeter.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """The base counts, one by one."""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


TEXTS = ["", "a b", "x y z x y z", "é ü ß \x85 a", "a\nb\na\n\n\n \n a\nb", "## $$ | a", "w " * 500, "\t\x0b\x0c\r", "a a a a", "\x1c\x1d b"]
TEXTS += ["Good prose with many different words " + " ".join(f"word{i}" for i in range(n)) for n in (10, 60, 400)]
TEXTS += ["# ".join(f"w{i}" for i in range(80)), "A" * 100_000, " ".join(f"WORD{chr(65 + i % 26)}{chr(65 + i // 26)}" for i in range(90))]


def test_counts_and_verdicts(spark):
    rows = [(i, t, "s", True) for i, t in enumerate(TEXTS)] + [(100, None, None, None), (100, None, None, None), (None, TEXTS[11], "s", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, kept boolean")
    out = quality.judged(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        want = plain(rows[r.doc_id][1]) if r.doc_id is not None and r.doc_id < 100 else plain(TEXTS[11] if r.doc_id is None else "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (r.rejected_by is None) and not (r.kept and r.base_failed)
    kept = {r.doc_id for r in out if r.kept}
    assert kept == {11, 12, None}
    left = quality.filter_documents(docs)
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    assert {r.doc_id for r in left.collect()} == kept
    assert quality.filter_documents(docs.limit(0)).count() == 0


def test_order_does_not_change_verdicts():
    texts = [t.encode() for t in TEXTS]
    names = list(quality.RULES)
    first = [v is None for v in quality.verdicts(texts, names)]
    assert first == [v is None for v in quality.verdicts(texts, names[::-1])]
