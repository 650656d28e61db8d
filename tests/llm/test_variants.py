import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from filingloom.llm import variants
from filingloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows, one_in, shortest=6, fewest=5):
    counts = Counter()
    for key, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(LOW)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if one_in and h % one_in == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += len(word) >= shortest
    return {w: n for w, n in counts.items() if n >= fewest}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def plain_near(words):
    """Neighbours of each word: pairs that share what is left when one place is blanked or left out."""
    by = {}
    for w in words:
        for i in range(len(w) + 1):
            for key in {w[:i] + "*" + w[i + 1 :], w[:i] + "*" + w[i:]}:
                by.setdefault(key, set()).add(w)
    near = {w: set() for w in words}
    for own in by.values():
        for a in own:
            near[a] |= {b for b in own if one_edit(a, b)}
    return near


def plain_groups(counts, ratio=5):
    near, out = plain_near(counts), []
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda u: (-counts[u], u), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, counts[w], len(near[w]), form[w], counts.get(form[w]), root))
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.select("word", "n", "n_near", "form", "form_n", "root").collect()))


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_spelling_forms"](spark, SF)
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert rows_of(got) == plain_groups(plain_words(rows, 199))


@pytest.mark.parametrize("letters, longest, many", [("ab", 10, 250), ("aéÿbcdefgh", 9, 500), ("a", 20, 30)])
def test_neighbours_are_those_of_all_pairs(spark, letters, longest, many):
    rng = random.Random(9)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(many)}
    for w in rng.sample(sorted(words), len(words) // 2):
        i, x = rng.randrange(len(w)), rng.choice(letters)
        words |= {w[:i] + x + w[i + 1 :], w[:i] + x + w[i:], w[:i] + w[i + 1 :]} - {""}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {tuple(r) for r in variants.neighbours(df).collect()}
    assert got == {(a, b) for a, own in plain_near(words).items() for b in own}


def test_long_words_cost_no_levels(spark, monkeypatch):
    levels, level = [], variants._level
    monkeypatch.setattr(variants, "_level", lambda states, depth: levels.append(depth) or level(states, depth))
    long = "".join(random.Random(1).choices("abcdef", k=20_000))
    words = [long, long[:15_000] + "x" + long[15_000:], long[:20] + long[21:], long[::-1], "shorter", "shortr"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {tuple(r) for r in variants.neighbours(df).collect()}
    assert got == {(a, b) for a, own in plain_near_few(words).items() for b in own} and len(levels) < 30


def plain_near_few(words):
    return {w: {u for u in words if one_edit(w, u)} for w in words}


def test_chains_lead_to_their_last_form(spark):
    counts = {"aaaaaa" + "b" * k: 5**k for k in range(1, 12)} | {"zzzzzz": 5, "zzzzzy": 24, "zzzzzx": 25}
    got = rows_of(variants.grouped(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == plain_groups(counts)
    assert {r[5] for r in got if r[0][0] == "a"} == {"aaaaaa" + "b" * 11}


def test_edges(spark, make_docs):
    text = "Größer größer GRÖßER groesser ×÷ÿ×÷ÿ abcdef's don't_stop " + "q" * 3_000
    rows = [(1, None), (2, ""), (None, text), (3, text), (3, text), (4, "grösser " * 30_000), (5, text.lower()), (6, text), (7, "Łodzka " * 9)]
    docs = make_docs(rows).withColumn("n", F.lit("clash")).withColumn("word", F.lit("clash"))
    for one_in in (None, 1, 3):
        words = {r["word"]: r["n"] for r in variants.vocabulary(docs, one_in).collect()}
        assert words == plain_words(rows, one_in)
        assert rows_of(variants.grouped(variants.vocabulary(docs, one_in))) == plain_groups(words)
    assert variants.grouped(variants.vocabulary(make_docs([]))).count() == 0
    assert rows_of(variants.grouped(variants.vocabulary(make_docs([(1, "single " * 5)])))) == [("single", 5, 0, None, None, "single")]
