import random

from fleetmeter.llm import language
from fleetmeter.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op4_language_id"](spark, sf).join(docs, "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 300
    assert sum(r.lang == r.lang_pred for r in rows) > 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_texts(spark):
    rows = [(i, "the house and the garden " * 3, "en", 1) for i in range(20)]
    rows += [(i, "la casa y el jardín de la abuela " * 3, "es", 1) for i in range(20, 40)]
    rows += [(i, "das haus und der garten dort " * 3, "de", 1) for i in range(40, 60)]
    odd = [(60, None, "en", 1), (61, "", None, 1), (62, "12 34 !!", "es", 1), (63, "x", None, 1), (None, "the garden", None, 1)]
    odd += [(64, "das haus und " * 20_000, None, 1)] * 2
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score int")
    out = {r.doc_id: r for r in language.identify(docs).collect()}
    assert {out[k].lang_pred for k in (60, 61, 62)} == {"und"}
    assert out[64].lang_pred == "de" and out[None].lang_pred == "en"
    assert all(out[r[0]].lang_pred == r[2] for r in rows)
    assert language.identify(docs).count() == len(rows) + len(odd)
    assert language.identify(docs.limit(0)).count() == 0
    unlabelled = docs.withColumn("lang", language.F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}


def test_every_language_is_learned(spark):
    rng, rows = random.Random(3), []
    for k in range(72):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(8)]
        for _ in range(12 if k < 64 else 9):
            rows.append((len(rows), " ".join(rng.choice(words) for _ in range(60)), f"x{k:02d}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r.lang_pred for r in language.identify(docs).collect()}
    assert sum(out[i] == lang for i, _, lang in rows) > 0.97 * len(rows)
    assert set(out.values()) == {lang for _, _, lang in rows}
