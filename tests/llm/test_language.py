import zlib

import numpy as np
from pyspark.sql import functions as F

from filingloom.llm import language
from filingloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op2_language_codes"](spark, SF).collect()
    assert len(got) == len(rows)
    kept = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)
    right = sum(r["lang_pred"] == rows[r["doc_id"]]["lang"] for r in kept)
    assert right / len(kept) > 0.98


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 5, 6, 12, 40):
        code = language.codewords(n)
        assert code.shape[0] == n
        assert ((code.min(0) == 0) & (code.max(0) == 1)).all()
        distance = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        assert distance >= (1 if n == 2 else 2)
    assert language.codewords(4).shape[1] == 7


def test_grams_do_not_depend_on_slices(monkeypatch):
    text = "Über die Straße, où ça va; " * 50
    whole = sorted(np.concatenate(list(language.gram_slices(text))).tolist())
    monkeypatch.setattr(language, "SLICE", 64)
    assert sorted(np.concatenate(list(language.gram_slices(text))).tolist()) == whole
    assert list(language.gram_slices("123 !?\n")) == []


def test_edges(make_docs):
    rows = [(i, "the house and the garden " * 3, "en") for i in range(30)]
    rows += [(100 + i, "das haus und der garten sind " * 3, "de") for i in range(30)]
    asked = [(1, None), (2, ""), (3, "123 ..."), (None, "the garden and the house"), (4, "der garten und das haus " * 20_000), (4, "x")]
    learned = make_docs(rows + asked)
    model = language.fit(learned, ~language.held_out())
    told = language.with_language(make_docs(asked).withColumn("score", F.lit("clash")), model)
    got = {(r["doc_id"], (r["text"] or "")[:5]): r for r in told.collect()}
    assert [got[k]["lang_pred"] for k in ((1, ""), (2, ""), (3, "123 ."))] == ["und"] * 3
    assert got[(None, "the g")]["lang_pred"] == "en" and got[(4, "der g")]["lang_pred"] == "de"
    kept = language.accepted(make_docs(asked), model)
    assert kept.columns == make_docs([]).columns
    assert {(r["doc_id"], r["text"][:5]) for r in kept.collect()} >= {(None, "the g"), (4, "der g")}
    assert language.with_language(make_docs([]), model).count() == 0


def test_nothing_to_learn(make_docs):
    docs = make_docs([(1, "some text", None), (2, None, "en")])
    model = language.fit(docs, ~language.held_out())
    assert {r["lang_pred"] for r in language.with_language(docs, model).collect()} == {"und"}
    one = make_docs([(i, "some text", "en") for i in range(8)])
    model = language.fit(one, ~language.held_out())
    assert {(r["lang_pred"], r["score"]) for r in language.with_language(one, model).collect()} == {("en", 1.0)}


def test_unknown_letters_are_ambiguous(make_docs):
    rows = [(i, "the house and the garden", "en") for i in range(20)] + [(50 + i, "das haus und der garten", "de") for i in range(20)]
    model = language.fit(make_docs(rows), ~language.held_out())
    assert not model.answer("the garden")[2]
    assert model.answer("the garden")[0] == "en"
