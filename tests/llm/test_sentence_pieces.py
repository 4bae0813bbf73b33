import random
import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from fleetmeter.llm import sentence_pieces as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library():
    """The library's own best-score segmentation over the same pieces."""
    model = proto.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def text(rng, n):
    letters = "etaoinshrdlu" * 3 + "éß%,.XYZ"
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 14))) for _ in range(n))


def test_equals_the_library():
    rng, ours, theirs = random.Random(1), sp.Model(PATH), library()
    for _ in range(50):
        one = text(rng, 40)
        assert np.frombuffer(ours.encode(one)[1], "<u4").tolist() == theirs.encode(one)


def test_chunks_equal_whole_texts(spark):
    rng, model = random.Random(2), sp.Model(PATH)
    rows = [(i, text(rng, rng.randrange(1, 60))) for i in range(40)]
    rows += [(50, text(rng, 3000).replace(" ", "")), (51, "a" * 5000), (52, " " * 700), (53, "\n\n\t  x" * 100), (54, "漢字かな\U0001f600" * 90)]
    rows += [(55, None), (56, ""), (57, " "), (None, "x"), (58, rows[0][1]), (58, rows[0][1]), (59, "a b  c " * 300)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int")
    for chunk in (7, 16, 100, 1 << 14):
        out = sp.encoded(docs, PATH, ids=True, chunk=chunk).collect()
        assert len(out) == len(rows)
        want = sorted((str(i), *model.encode(t or "")) for i, t in rows)
        assert sorted((str(r.doc_id), r.score, bytes(r.ids)) for r in out) == want
        own = sorted((str(i), zlib.crc32(model.merge(t or ""))) for i, t in rows)
        assert sorted((str(r.doc_id), r.model_crc32) for r in out) == own
        for r in out:
            assert r.decoded and r.ids_crc32 == zlib.crc32(r.ids) and r.n_pieces == len(r.ids) // 4
        back = sp.decoded(spark.createDataFrame([(r.doc_id, r.ids) for r in out], "doc_id long, ids binary"), PATH)
        assert sorted(((str(r.doc_id), r.text) for r in back.collect())) == sorted((str(i), t or "") for i, t in rows)
    assert sp.encoded(docs.limit(0), PATH).count() == 0


def test_products_are_associative():
    rng = np.random.default_rng(3)
    a, b, c = (rng.integers(-9, 9, (4, 4)).astype(float) for _ in range(3))
    assert (sp.product(sp.product(a, b), c) == sp.product(a, sp.product(b, c))).all()
    total, scores = sp.entries([a, b, c])
    assert total == sp.product(sp.product(a, b), c)[0, 0]
    assert (scores[1] == a[0]).all() and (scores[2] == sp.product(a, b)[0]).all()


def cut(model, text, chunk):
    """The encoding of a text in chunks, without Spark."""
    text, rows = sp.marked(text), []
    for at in range(0, len(text), chunk):
        rows.append((text[at : at + chunk + model.longest - 1], min(chunk, len(text) - at), text[max(0, at - 1) : at]))
    got = [model.transfer(*row) for row in rows]
    total, scores = sp.entries([g[0] for g in got])
    sizes = [size - len(part) + len(g[3]) for (part, size, _), g in zip(rows, got, strict=True)]
    traces = [model.trace(*g[1:], size, entry) for g, size, entry in zip(got, sizes, scores, strict=True)]
    return total, sp.picked([dict(zip(("stem", "firsts", "ends"), t, strict=True)) for t in traces])


def test_ties_do_not_depend_on_chunks():
    rng, model = random.Random(7), sp.Model(PATH)
    texts = ["".join(rng.choices(["$", "$$", "=", "==", "-", ".", "..", " ", "the", "he", "\n", "漢"], k=120)) for _ in range(60)]
    for one in [*texts, "$" * 300, " " * 200, "a" * 300]:
        whole = model.encode(one)
        for chunk in (1, 2, 5, 15, 16, 17, 64, 100):
            assert cut(model, one, chunk) == whole


def test_library_and_own_programme_agree():
    rng, model = random.Random(8), sp.Model(PATH)
    parts = sp._PART.findall(sp.marked(text(rng, 500) + " the then there house"))
    parts += ["▁\n\n\tx", "▁漢字", "▁\U0001f600é", "▁\x00a", "▁<s>", "▁<0x41>", "▁" * 40, "▁" + "ab" * 40, "▁\n漢\n\n字the"]
    assert [got[:2] for got in model._solved(parts)] == list(map(model.alone, parts))


def test_own_ids_are_those_of_the_model():
    rng, model = random.Random(9), sp.Model(PATH)
    reader = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for one in [text(rng, 60), "the  house\n\n   of\tthe 漢字 \U0001f600", "", " ", "   the", "a" * 300, "=" * 99]:
        assert np.frombuffer(model.merge(one), "<u4").tolist() == reader.encode(one)


def test_runs_of_blanks_over_a_border(spark):
    rng, model, chunk = random.Random(5), sp.Model(PATH), 96
    rows = []
    for run in range(3, 21):
        for off in range(run + 1):
            head = (text(rng, 40) + " the")[-(chunk - 1 - off) :].strip().rjust(chunk - 1 - off, "x")
            rows.append((len(rows), head + " " * run + "the end of " + text(rng, 30)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in sp.encoded(docs, PATH, ids=True, chunk=chunk).collect()}
    wrong = [i for i, t in rows if (got[i].score, got[i].n_pieces) != (model.encode(t)[0], len(model.encode(t)[1]) // 4)]
    assert not wrong and all(r.decoded for r in got.values())
