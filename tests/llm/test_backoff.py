import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from filingloom.llm import backoff
from filingloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, mass=backoff.MASS):
    """(held_out, n_tokens, n_known, N, base, score) per row from counts of words and pairs."""
    tokens, words, pairs = [], Counter(), Counter()
    for doc_id, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)) + [None]
        held = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2
        tokens.append((held, own))
        if not held:
            words.update(own)
            pairs.update(zip(["<begin>", *own], own))
    n, v, out = sum(words.values()), len(words), []
    for held, own in tokens:
        chance = [(words[w] + 1) / (n + v + 1) for w in own]
        score = 0.0
        for i, w in enumerate(own):
            before = "<begin>" if i == 0 else own[i - 1]
            seen = words[None] if i == 0 else words[before]
            score += math.log10((pairs[before, w] + mass * chance[i]) / (seen + mass))
        out.append((held, len(own), sum(words[w] > 0 for w in own), n, sum(map(math.log10, chance)), score))
    return out


def same(got, expected):
    return got[:4] == expected[:4] and all(a == pytest.approx(b, rel=1e-9, abs=1e-9) for a, b in zip(got[4:], expected[4:]))


@pytest.mark.parametrize("sizes", [(4 << 20, 1_500_000), (20_000, 5_000)])
def test_query_equals_plain_counts(spark, monkeypatch, sizes):
    monkeypatch.setattr(backoff, "BLOCK_BYTES", sizes[0])
    monkeypatch.setattr(backoff, "BUCKET_ENTRIES", sizes[1])
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op3_backoff_score"](spark, SF).collect()}
    expected = plain(rows)
    assert len(got) == len(rows)
    assert all(same(got[d], e) for (d, _), e in zip(rows, expected))
    held = [e for e in expected if e[0]]
    assert sum(e[5] for e in held) > sum(e[4] for e in held)


def test_edges(make_docs):
    rows = [(1, "A b a"), (1, "A b a"), (None, "b </s> b"), (3, None), (4, ""), (5, "É é x \x1c y"), (6, "long " * 60_000)]
    docs = make_docs(rows).withColumn("score", F.lit("clash"))
    got = backoff.scored(docs, ~backoff.held_out()).collect()
    expected = Counter((r[0], *(round(x, 6) for x in e[1:])) for r, e in zip(rows, plain(rows)))
    names = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    assert Counter((r["doc_id"], *(round(r[n], 6) for n in names)) for r in got) == expected
    assert backoff.scored(make_docs([]), ~backoff.held_out()).count() == 0
    nothing = backoff.scored(make_docs([(1, "a b")]), F.lit(False)).first()
    assert (nothing["n_tokens"], nothing["n_known"], nothing["train_tokens"]) == (3, 0, 0)


def test_state_probabilities_sum_to_one():
    block = backoff.Block(["a b a c", "b a", "c"], [True] * 3)
    counts, total = block.counts, int(block.counts.sum()) // 2
    v, words = block.n_words, ["a", "b", "c", None]
    texts = plain([(0, "a b a c"), (0, "b a"), (0, "c")])
    assert total == texts[0][3]
    walked = backoff.walk(block, counts.astype("uint64"), total, v, 10.0)
    assert walked.n_known.tolist() == [5, 3, 2]
    n, seen, pairs = 10, {"a": 3, "b": 2, "c": 2, None: 3}, {("a", "b"): 1, ("a", "c"): 1, ("a", None): 1}
    root = {w: (seen[w] + 1) / (n + v + 1) for w in words}
    inside = sum((pairs.get(("a", w), 0) + 10 * root[w]) / (seen["a"] + 10) for w in words)
    assert inside + 10 / (seen["a"] + 10) / (n + v + 1) == pytest.approx(1)
