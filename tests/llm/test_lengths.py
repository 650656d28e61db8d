from collections import Counter

from filingloom.llm import lengths
from filingloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def encoded(texts):
    encode = lengths.encoding(f"{lengths.TOKENIZERS}/{lengths.RANKS}").encode_ordinary
    return [len(encode(t or "")) for t in texts]


def same(sums, sizes):
    counts, total = Counter(sizes), sum(sizes)
    rows = {r["length"]: r for r in lengths.context_report(sums).collect()}
    assert {n: r["n_docs"] for n, r in rows.items()} == counts
    for n, r in rows.items():
        assert r["docs_from"] == sum(s >= n for s in sizes) and r["tokens_from"] == sum(s for s in sizes if s >= n)
        assert r["docs_cut"] == sum(s > n for s in sizes)
        assert r["tokens_kept"] == sum(min(s, n) for s in sizes) == total - r["tokens_lost"]
    for limit in (0, 1, 7, 100, 10**6):
        assert lengths.kept_tokens(sums, limit) == sum(min(s, limit) for s in sizes)
    for share in (0.1, 0.5, 0.9, 1.0):
        if sizes:
            ordered = sorted(sizes)
            assert lengths.quantile(sums, share) == next(s for i, s in enumerate(ordered) if i + 1 >= share * len(ordered))


def test_query_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = encoded(r["text"] for r in docs.select("text").collect())
    report = {r["length"]: r for r in QUERIES["op7_token_lengths"](spark, SF).collect()}
    assert {n: r["n_docs"] for n, r in report.items()} == Counter(sizes)
    same(lengths.summed(docs), sizes)


def test_edges(make_docs):
    rows = [(1, None), (1, None), (2, ""), (3, "one"), (4, "<|endoftext|> é"), (5, "word " * 30_000), (None, "a" * 2_000)]
    sums = lengths.suffix_sums(lengths.length_histogram(make_docs(rows)), block=3)
    same(sums, encoded(t for _, t in rows))
    empty = lengths.summed(make_docs([]))
    assert empty.count() == 0 and lengths.kept_tokens(empty, 5) == 0 and lengths.quantile(empty, 0.5) is None


def test_long_runs_of_white_space():
    whole = lengths.encoding(f"{lengths.TOKENIZERS}/{lengths.RANKS}").encode_ordinary
    for n in (1, 9_999, 10_000, 10_001, 60_000, 500_000):
        for text in (" " * n, " " * n + "x", "a b" + "\n" * n + " x", "\u3000\t" * n + "1  2", f"a{' ' * n}b{' ' * n}!{chr(160) * n}'s\x1c "):
            assert lengths.count_tokens(text) == len(whole(text)) if len(text) <= 600_000 else True
    for text in (" " * 1_000_000 + "x", "\n" * 1_000_000 + "x", "=" * 1_000_000, "a" * 1_000_000):
        assert 0 < lengths.count_tokens(text) <= len(text)
