import math
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from filingloom.llm import mixing
from filingloom.llm.oracle import ORACLE
from filingloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def targets_by_rounds(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Deal the total by weight, stop sources at their most, deal what is over again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, full, total = set(order), {}, share * sum(sizes.values())
    while left:
        rest = total - sum(full.values())
        level = rest / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * level > most * sizes[s]}
        if not over:
            return full | {s: weight[s] * level for s in left}
        full |= {s: most * sizes[s] for s in over}
        left -= over
    return full


ROWS = [
    (1, "a b c", "en", "b"),
    (1, "a b c", "en", "b"),
    (2, None, "en", "b"),
    (3, "", "en", "a"),
    (4, "x " * 400, "en", "a"),
    (5, "one word two", "en", None),
    (None, "no id here", "en", "c"),
    (6, "\x0b tab\x0cform \x1c", "en", "zero"),
    (7, None, "en", "empty"),
]


def test_targets_match_dealing_in_rounds(make_docs):
    got = {r["source"]: r for r in mixing.source_targets(make_docs(ROWS)).collect()}
    sizes = {}
    for row in ROWS:
        sizes[row[3]] = sizes.get(row[3], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or ""))
    expected = targets_by_rounds(sizes)
    assert {s: r["source_size"] for s, r in got.items()} == sizes
    for source, r in got.items():
        assert r["target"] == pytest.approx(expected[source])


def test_copies_are_whole_part_and_one_draw(make_docs):
    got = mixing.with_copies(make_docs(ROWS)).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert r["copies"] in (math.floor(r["rate"]), math.floor(r["rate"]) + 1)
        assert r["size"] * r["copies"] <= 2 * r["size"]
    again = mixing.with_copies(make_docs(ROWS)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_emitted_rows_follow_the_copies(make_docs):
    docs = make_docs(ROWS).withColumn("copy", F.lit("clash"))
    copies = sum(r["copies"] for r in mixing.with_copies(docs).collect())
    mix = mixing.mixed(docs)
    assert mix.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy"]
    assert mix.count() == copies


def test_many_documents_come_near_the_target(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise("x").alias("source")
    )
    got = mixing.with_copies(docs).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("n"), F.first("target").alias("t"))
    for r in got.collect():
        assert abs(r["n"] - r["t"]) < 0.05 * r["t"]


def test_empty_table(make_docs):
    assert mixing.with_copies(make_docs([])).count() == 0
    assert mixing.mixed(make_docs([])).count() == 0


def test_query_matches_sql(spark):
    got = QUERIES["op1_mix_sources"](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rel = con.sql(ORACLE["op1_mix_sources"])
    at = [rel.columns.index(c) for c in got.columns]
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r[i] for i in at) for r in rel.fetchall())
