from collections import Counter

import corpus_pipeline
from filingloom.llm import secrets
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, kept, SF)
        assert found.columns == columns, name
        rows = found.collect()
        assert len({r["doc_id"] for r in rows}) == len(rows)
        assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in kept.select("doc_id").collect()}
        kept = spark.createDataFrame(rows, docs.schema)
    scanner = secrets.Scanner()
    assert not any(k in ("access", "hex") for r in kept.collect() for k, _, _ in scanner.spans(r["text"]))
    assert 0.8 < kept.count() / len(before) < 1


def test_run_mixes_what_is_left(spark):
    mix = corpus_pipeline.run(spark, SF)
    counts = Counter(r["doc_id"] for r in mix.collect())
    assert counts and max(counts.values()) <= 2
    assert set(mix.columns) == {"doc_id", "text", "lang", "source", "n_chars", "copy"}
    assert sorted(map(repr, corpus_pipeline.run(spark, SF).collect())) == sorted(map(repr, mix.collect()))


def test_stages_take_empty_tables(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").filter(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
