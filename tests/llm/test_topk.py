import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingloom.llm import topk
from filingloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(rows, asked, k):
    """The best rows of each query among (vec_id, integers), all pairs compared."""
    out = []
    for query, own in rows:
        if query is None or not asked(query):
            continue
        found = [(-sum(a * b for a, b in zip(own, v)), i is None, i or 0, i) for i, v in rows if i != query]
        out += [(query, rank + 1, i, -score) for rank, (score, _, _, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def found(spark, rows, k=3, **sizes):
    vectors = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    got = topk.top_rows(vectors, F.col("vec_id") % 5 == 0, k, **sizes)
    return sorted(map(tuple, got.collect()), key=repr)


def test_query_on_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    whole = [(r["vec_id"], [math.floor(64 * x) for x in r["embedding"]]) for r in rows]
    got = QUERIES["op12_max_score"](spark, SF)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(whole, lambda i: i % 20 == 0, 20)


@pytest.mark.parametrize("sparse", [0.0, 0.9])
@pytest.mark.parametrize("sizes", [{}, {"shard_values": 300, "block_values": 60}])
def test_shards_and_blocks_give_all_pairs_result(spark, sparse, sizes):
    rng = random.Random(5)
    rows = [(i, [0 if rng.random() < sparse else rng.randint(-9, 9) for _ in range(12)]) for i in range(150)]
    # A group of copies of one vector, and two of opposite sign: many equal scores.
    rows += [(i, rows[0][1]) for i in range(150, 230)] + [(i, [-x for x in rows[0][1]]) for i in range(230, 240)]
    assert found(spark, rows, **sizes) == plain(rows, lambda i: i % 5 == 0, 3)


def test_terms_that_are_not_essential_are_probed_for_competitive_rows_alone(monkeypatch):
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.integers(-9, 10, (400, 32)), rng.integers(20, 30, (30, 32))])
    queries = rng.integers(5, 30, (4, 32))
    scores = queries @ rows.T
    beat = np.sort(scores, axis=1)[:, -5].astype(float)
    shard, essential = topk.Shard(np.arange(430), rows), []
    traverse = shard._traverse
    monkeypatch.setattr(shard, "_traverse", lambda q, order, first, kind: essential.append(first) or traverse(q, order, first, kind))
    query, row, score = shard.search(np.full(4, -1), queries, beat, 5)
    assert (essential[0] < 32).all() and (essential[0] > 0).all()
    for i in range(4):
        best = np.lexsort((np.arange(430), -scores[i]))[:5]
        assert row[query == i].tolist() == best.tolist() and score[query == i].tolist() == scores[i][best].tolist()


def test_edges(spark):
    big = 1 << 29
    rows = [(0, [1, 2]), (0, [3]), (5, []), (10, [big, -big, big]), (1, [big, -big, big - 1]), (1, [big, -big, big - 1])]
    rows += [(None, [1, 2]), (None, [5, 5]), (2, [1, 2, 0, 0, 7]), (3, [1, 2])]
    assert found(spark, rows) == plain(rows, lambda i: i % 5 == 0, 3)
    assert found(spark, rows, k=100, shard_values=4, block_values=3) == plain(rows, lambda i: i % 5 == 0, 100)
    assert found(spark, []) == [] and found(spark, [(5, [1])]) == [] and found(spark, [(1, [1]), (None, [2])]) == []


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.01]), (2, None), (3, [0.1, None]), (4, [nan]), (5, [-inf, 1.0]), (6, [])]
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
        got = df.select("vec_id", topk.whole_components(F.col("embedding"))).collect()
        assert [tuple(r) for r in got] == [(1, [32, -1]), (2, None), (3, None), (4, None), (5, None), (6, [])]


def test_large_whole_numbers_are_exact(spark):
    rows = [(0, [3_000_000_001, 7]), (1, [2_000_000_003, -1]), (2, [2_000_000_003, 1]), (3, [2_000_000_003, 0])]
    assert found(spark, rows) == plain(rows, lambda i: i % 5 == 0, 3)
