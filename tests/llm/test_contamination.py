import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from filingloom.llm import contamination
from filingloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(docs, items, width=13):
    """(n_words, n_hit, items, contaminated) per document."""
    windows = defaultdict(set)
    for item_id, text in items:
        words = WORD.findall((text or "").translate(LOW))
        for i in range(max(1, len(words) - width + 1)) if words else ():
            windows[tuple(words[i : i + width])].add(str(item_id))
    out = []
    for _, text in docs:
        words, hit, found = WORD.findall((text or "").translate(LOW)), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if (own := tuple(words[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[own]
        out.append((len(words), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def test_query_on_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    expected = set()
    for (doc_id, _), (n, hit, found, bad) in zip(docs, plain(docs, items)):
        expected.add((doc_id, n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bad))
    got = QUERIES["op5_decontaminate"](spark, SF).drop("n_near").collect()
    assert len(got) == len(docs) and {tuple(r) for r in got} == expected
    assert any(e[5] for e in expected)


def case(spark, make_docs, rows, item_rows):
    items = spark.createDataFrame(item_rows, "item_id long, text string")
    docs = make_docs(rows).withColumn("n_hit", F.lit("clash"))
    got = contamination.contaminated(docs, items).collect()
    key = lambda r: (str(r[0]), *r[1:])
    found = [(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in got]
    expected = [(d[0], n, h, tuple(i), c) for d, (n, h, i, c) in zip(rows, plain(rows, item_rows))]
    assert sorted(found, key=key) == sorted(expected, key=key)
    kept = contamination.clean(docs, items)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not e[4] for e in expected)


def test_edges(spark, make_docs):
    long_item = " ".join(f"t{i}" for i in range(30))
    items = [
        (1, long_item),
        (2, "Short item HERE"),
        (3, "solo"),
        (4, None),
        (5, "... !"),
        (6, "a a a a a a a a a a a a a a"),
        (10, "ΑΣ'Α und Éa"),
        (1, "again t1"),
    ]
    rows = [
        (1, None),
        (2, ""),
        (2, "..."),
        (3, f"x {long_item.upper()} y"),
        (3, f"x {long_item.upper()} y"),
        (None, "a short, item: here! solo"),
        (4, "a " * 40),
        (5, " ".join(f"t{i}" for i in range(12))),
        (6, "ΑΣ Α und Éa; ας α und éa"),
        (7, "w " * 5_000 + long_item + " q" * 50_000),
        (8, "again t1 again t1 tail"),
        (9, " ".join(f"t{i}" for i in (*range(5), 99, *range(5, 30)))),
    ]
    case(spark, make_docs, rows, items)


def test_empty_sides(spark, make_docs):
    case(spark, make_docs, [(1, "some words here")], [])
    case(spark, make_docs, [], [(1, "some words here")])


def test_without_broadcast(spark, make_docs, monkeypatch):
    monkeypatch.setattr(contamination, "broadcast_if_small", lambda df, *a, **k: df)
    item = " ".join(f"t{i}" for i in range(20))
    case(spark, make_docs, [(i, f"{i} {item} {i % 3}") for i in range(40)], [(1, item), (2, "t3 t4")])


def plain_near(docs, items, width=13):
    """Per document: items of which a window has all its words near some place of its rarest word."""
    texts = [WORD.findall((t or "").translate(LOW)) for _, t in docs]
    counts = Counter(w for words in texts for w in words)
    out = []
    for words in texts:
        places = defaultdict(list)
        for i, w in enumerate(words):
            places[w].append(i)
        met = set()
        for item_id, text in items:
            own = WORD.findall((text or "").translate(LOW))
            for i in range(max(1, len(own) - width + 1)) if own else ():
                win = own[i : i + width]
                rare = min(enumerate(win), key=lambda x: (counts[x[1]], x[0]))[1]
                near = lambda w, p: any(abs(q - p) < width for q in places[w])
                if any(all(near(w, p) for w in win) for p in places[rare]):
                    met.add(str(item_id))
        out.append(len(met))
    return out


def test_proximity_by_brute_force(spark, make_docs):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice((1, 2, 3, 14))))) for i in range(12)] + [(3, "w1 w2"), (90, "w1 w1 w1")]
    rows = [(i, " ".join(rng.choices(words, weights=range(1, 13), k=rng.choice((0, 1, 5, 40, 300))))) for i in range(25)]
    rows.append(rows[-1])
    got = contamination.contaminated(make_docs(rows), spark.createDataFrame(items, "item_id long, text string"))
    found = sorted((r["doc_id"], r["n_near"]) for r in got.collect())
    assert found == sorted((d[0], n) for d, n in zip(rows, plain_near(rows, items)))
    case(spark, make_docs, rows, items)


def test_near_words_in_any_order(spark, make_docs):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = make_docs([(1, "gamma x beta alpha"), (2, "alpha " + "x " * 20 + "beta gamma"), (3, "alpha beta gamma")])
    got = {r["doc_id"]: r for r in contamination.contaminated(docs, items).collect()}
    assert [got[i]["n_near"] for i in (1, 2, 3)] == [1, 0, 1]
    assert [len(got[i]["items"]) for i in (1, 2, 3)] == [0, 0, 1]


def test_repeated_rows_meet_once(spark, make_docs):
    items = [(1, "one two three four")]
    case(spark, make_docs, [(None, "a one two three four b")] * 300 + [(7, "one two four")], items)


def test_long_lists_without_broadcast(spark, make_docs, monkeypatch):
    monkeypatch.setattr(contamination, "BROADCAST_BYTES", 0)
    case(spark, make_docs, [(1, "a " * 3000 + "b a a"), (2, "a b a a")], [(1, "a b a a"), (2, "a " * 13)])
