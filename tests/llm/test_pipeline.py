import hashlib
import zlib

import numpy as np
import public_tokenizers
import test_line_dedup
import test_near_duplicates
import test_suffix_dedup
from test_quality import plain
from tokenizers import Tokenizer

import corpus_pipeline
from fleetmeter.llm import quality

SF_DIR = "/root/testdata/sf0.001"


def brute(rows):
    """(doc_id, text) rows after the stages that come before packing, stage by stage."""
    order = list(quality.RULES)
    rows = [r for r in rows if quality.verdicts([(r[1] or "").encode()], order) == [None]]
    assert all(plain(t)[0] >= 50 for _, t in rows)
    yield rows
    places, out = {}, []
    for doc_id, text in rows:
        for pos, c in enumerate(test_line_dedup.chunks(text)):
            if len(c) > 1:
                here = places.setdefault("\n".join(c), (doc_id, pos))
                places["\n".join(c)] = min(here, (doc_id, pos))
    for doc_id, text in rows:
        own = test_line_dedup.chunks(text)
        stay = ["\n".join(c) for pos, c in enumerate(own) if len(c) == 1 or places["\n".join(c)] == (doc_id, pos)]
        out.append((doc_id, "\n".join(stay)))
    yield out
    rows = out
    classes = dict(test_near_duplicates.brute(rows))
    rows = [r for r in rows if classes[r[0]] == r[0]]
    yield rows
    digests = {r[0]: r[4] for r in test_suffix_dedup.brute(rows, 50)}
    yield rows, digests


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    steps = list(brute([(r.doc_id, r.text) for r in docs.collect()]))
    for (_, stage), want in zip(corpus_pipeline.STAGES[:3], steps, strict=False):
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "t")
        assert docs.columns == columns
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(want)
    rows, digests = steps[3]
    docs = corpus_pipeline.STAGES[3][1](spark, docs, SF_DIR)
    assert docs.columns == columns
    got = {r.doc_id: r.text for r in docs.collect()}
    assert set(got) == {r[0] for r in rows}
    # a removal may cut into a character; elsewhere the bytes that stay are those of brute force
    assert sum(hashlib.sha256(t.encode()).hexdigest() == digests[i] for i, t in got.items()) > 0.9 * len(got)
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts = {}
    for r in out:
        assert zlib.crc32(r.ids) == r.ids_crc32
        parts.setdefault(r.doc_id, []).append((r.piece, bytes(r.ids)))
    for i, text in got.items():
        ids = np.frombuffer(b"".join(x for _, x in sorted(parts[i])), "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids + [0]


def test_odd_rows(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None, "a", 1), (2, "", "a", 1), (3, good, "b", 2), (4, good, "b", 2), (None, good + " more", "c", 3), (5, "x " * 90, "d", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, rest long")
    for frame, many in ((docs, 1), (docs.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = corpus_pipeline.stored(stage(spark, frame, SF_DIR), name)
            assert frame.columns == docs.columns and frame.dtypes == docs.dtypes
        assert frame.count() == many
        assert corpus_pipeline.STAGES[-1][1](spark, frame, SF_DIR).count() == many
    raw = corpus_pipeline.STAGES[3][1](spark, docs, SF_DIR)
    assert sorted((str(r.doc_id), r.text, r.kept, r.rest) for r in raw.collect() if r.doc_id in (1, 2)) == [("1", None, "a", 1), ("2", "", "a", 1)]
