import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetmeter.llm import packing

FILES = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def one_by_one(lengths, limit):
    """Best-fit decreasing with a plain search; the number of bins and the sorted fill levels."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [b for b in bins if limit - sum(b) >= n]
        best = min(fit, key=lambda b: limit - sum(b), default=None)
        if best is None:
            bins.append([n])
        else:
            best.append(n)
    return sorted(sum(b) for b in bins)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_plan_equals_packing_one_by_one(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    fill, used = {}, {}
    for length, lo, hi, per, first, offset in packing.best_fit(counts, 20):
        for rank in range(lo, hi):
            b, at = first + (rank - lo) // per, offset + (rank - lo) % per * length
            used.setdefault(b, []).append((at, length))
            fill[b] = fill.get(b, 0) + length
    assert sorted(fill.values()) == one_by_one(lengths, 20)
    for parts in used.values():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length


def test_tokens_equal_the_tokenizers_library():
    texts = ["", "a", " a", "a  b", "it's we'll\n\n x", "a \n b", "é ñ\t!!", "x y z", "1234 56,7", "a b ", "<|endoftext|> a", "\x00 b", "the the the"]
    whole = Tokenizer.from_file(FILES[0])
    got = packing.Encoder(*FILES).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_documents_are_packed_whole(spark):
    long = "word and other words, " * 2000
    rows = [(1, "a b c", "x"), (2, None, "y"), (3, "", None), (4, long, "z"), (5, "a b c", "x"), (5, "a b c", "x"), (None, "d", "x")]
    rows += [(10 + i, "some words " * (i % 30), "s") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece string")
    out = packing.pack_documents(docs, *FILES, ids=True).collect()
    whole = Tokenizer.from_file(FILES[0])
    assert len({(r.sequence_id, r.offset) for r in out}) == len(out)
    by = {}
    for r in out:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by.setdefault(r.sequence_id, []).append(r)
    for parts in by.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.LIMIT
    four = sorted((r for r in out if r.doc_id == 4), key=lambda r: r.piece)
    ids = np.frombuffer(b"".join(bytes(r.ids) for r in four), "<u4").tolist()
    assert ids == whole.encode(long, add_special_tokens=False).ids + [0]
    assert [r.length for r in four][1:] == [packing.LIMIT] * (len(four) - 1)
    assert sum(r.doc_id == 5 for r in out) == 2
    empty = docs.limit(0)
    assert packing.pack_documents(empty, *FILES).count() == 0
