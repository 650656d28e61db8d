import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from filingloom.llm import simhash
from filingloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius=2):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (int(prints[i]) ^ int(prints[j])).bit_count() <= radius:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def clustered(seed, centres=12, each=12):
    rng, out = random.Random(seed), set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(each):
            x = centre
            for _ in range(rng.choice((0, 1, 1, 2, 3))):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_groups_equal_pairwise(radius):
    for seed in range(3):
        prints = clustered(seed)
        near = dict(simhash.stars(prints, radius))
        assert [near.get(i, i) for i in range(len(prints))] == plain_groups(prints, radius)
        parts = [prints[i : i + 40] for i in range(0, len(prints), 40)]
        for part, found in zip(parts, simhash.small_stars(parts, radius)):
            near = dict(found)
            assert [near.get(i, i) for i in range(len(part))] == plain_groups(part, radius)


def altered(words, share, rng):
    """The words with about this share of them replaced, one here and there."""
    return [f"new{rng.randrange(10**9)}" if rng.random() < share else w for w in words]


@pytest.mark.parametrize("group", [4096, 8])
def test_links_connect_what_is_near(spark, group):
    prints = clustered(7, centres=6, each=30)
    nodes = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fingerprint long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes, group=group)).collect()}
    own = [roots.get(int(x), int(x)) for x in prints.view(np.int64)]
    groups = plain_groups(prints)
    assert {(a, b) for a, b in zip(own, groups)} == set(zip(own, groups))
    assert len(set(zip(own, groups))) == len(set(own)) == len(set(groups))


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert {roots[i] for i in range(201)} == {0} and roots[501] == 500


def test_query_on_whole_table(spark):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    prints = [plain_print(t) for _, t in rows]
    groups = plain_groups(prints)
    expected = {(d, f"{p:016x}", rows[g][0]) for (d, _), p, g in zip(rows, prints, groups)}
    got = QUERIES["op6_simhash_groups"](spark, SF).collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == expected


def test_edges(make_docs):
    long = "word%d " * 3
    text = " ".join(f"w{i % 700}" for i in range(50_000))
    rows = [(5, None), (4, ""), (3, " \t"), (8, "one"), (7, "ONE"), (None, "one"), (9, text), (10, text), (10, text), (11, long)]
    docs = make_docs(rows).withColumn("component_id", F.lit("clash"))
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got}
    assert by[5] == by[4] == by[3] == (0, 3)
    assert by[8][1] == by[7][1] == by[None][1] == 7 and by[9][1] == by[10][1] == 9
    kept = sorted((r["doc_id"], r["text"]) for r in simhash.one_of_each(docs).collect())
    assert kept == sorted([(3, " \t"), (7, "ONE"), (9, text), (11, long)])
    assert simhash.near_duplicates(make_docs([])).count() == 0
    assert simhash.one_of_each(make_docs([])).count() == 0


def test_repeated_rows_leave_one(make_docs):
    kept = simhash.one_of_each(make_docs([(1, "a b c d"), (1, "a b c d"), (2, "q r s t u v")])).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 2]


@pytest.mark.parametrize("seed", [1, 2])
def test_stage_keeps_one_of_each_group_by_all_pairs(make_docs, seed):
    rng, texts = random.Random(seed), [None, "", " ", "one", "ONE", "one two", "two one"]
    for k in range(40):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice((8, 120, 2000)))]
        texts += [" ".join(altered(words, rng.choice((0, 0.001, 0.005, 0.02)), rng)) for _ in range(30 if k == 0 else 4)]
    rng.shuffle(texts)
    groups = plain_groups([plain_print(t) for t in texts])
    kept = [r["doc_id"] for r in simhash.one_of_each(make_docs(list(enumerate(texts)))).collect()]
    assert sorted(kept) == sorted(set(groups)) and len(kept) < len(set(texts))


def test_rows_are_decided_each_not_by_id(make_docs):
    a, b, c, d, e = (" ".join(f"{k}{i}" for i in range(30)) for k in "abcde")
    rows = [(7, a, "x"), (None, a, "x"), (None, b, "x"), (None, c, "x"), (None, c, "x"), (None, None, "x")]
    rows += [(1, d, "x"), (8, d, "x"), (8, e, "y"), (8, e, "x"), (9, e, "x"), (8, c, "x"), (8, "z", "x")]
    got = simhash.one_of_each(make_docs(rows)).select("doc_id", "text", "lang").collect()
    expected = [(7, a, "x"), (None, b, "x"), (None, None, "x"), (1, d, "x"), (8, e, "x"), (8, c, "x"), (8, "z", "x")]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
