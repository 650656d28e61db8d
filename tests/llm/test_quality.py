import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from filingloom.llm import quality
from filingloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\r\x0b\x0c")]
    places, covered = defaultdict(list), set()
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    for found in places.values():
        if len(found) > 1:
            for i in found:
                covered.update(range(i, i + 8))
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_query_on_whole_table(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op9_quality_rules"](spark, SF).collect()
    assert len(got) == len(docs)
    assert all(tuple(r[c] for c in STATS) == plain(docs[r["doc_id"]]) for r in got)
    assert not any(r["kept"] and r["base_failed"] for r in got)
    passed = [r for r in got if not r["base_failed"] and r["doc_id"] in label]
    good = [r["kept"] for r in passed if label[r["doc_id"]] == 1]
    bad = [r["kept"] for r in passed if label[r["doc_id"]] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.2


def test_edges(make_docs):
    line = "one two three four five six seven eight nine\n"
    rows = [(1, None), (1, ""), (None, " \n\n "), (2, line * 2000), (3, line + "x y z\n" + line), (3, "é # | <tag>\r\n" * 3)]
    docs = make_docs(rows).withColumns({"kept": F.lit("clash"), "distance": F.lit("clash")})
    got = quality.judged(docs).collect()
    assert sorted(tuple(r[c] for c in STATS) for r in got) == sorted(plain(t) for _, t in rows)
    assert all(r["kept"] == (not r["base_failed"]) for r in got)
    assert quality.judged(make_docs([])).count() == 0


def test_outliers_go_and_groups_stay_apart(make_docs):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        lang, source = rng.choice((("en", "a"), ("de", "a"), (None, None)))
        size = {"en": 4, "de": 8, None: 6}[lang]
        words = ["".join(rng.choice("abcdefgh") for _ in range(max(1, round(rng.gauss(size, 1))))) for _ in range(rng.randrange(40, 120))]
        junk = i % 5 == 0
        rows.append((i, " ".join(w + "###" if junk else w for w in words), lang, source))
    got = {r["doc_id"]: r["kept"] for r in quality.judged(make_docs(rows)).collect()}
    assert [i for i in got if got[i] == (i % 5 == 0)] == []


def test_inverse_and_small_groups(spark, make_docs):
    rng = np.random.default_rng(1)
    a = rng.normal(size=(5, 5))
    cov = a @ a.T + 3 * np.eye(5)
    row = {"_group": "g", "scale": 1.0} | {f"m{i}": 0.0 for i in range(5)} | {f"c{i}{j}": float(cov[i, j]) for i in range(5) for j in range(i + 1)}
    found = quality._inverted(spark.createDataFrame([row])).first()
    inverse = np.linalg.inv(cov)
    assert all(abs(found[f"p{i}{j}"] - inverse[i, j]) < 1e-5 for i in range(5) for j in range(i + 1))
    few = make_docs([(i, "plain words " * 12 + str(i), "en", str(i)) for i in range(10)])
    assert all(r["distance"] is None for r in quality.judged(few).collect())
