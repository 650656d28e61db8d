import hashlib
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from filingloom.llm import alignment
from filingloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


@pytest.fixture(scope="module")
def plain():
    """Brute force over (id, text) rows: tokens with their byte ends, groups and links one by one."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(alignment.FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=alignment.SECOND)
    spelt = {i: t for t, i in json.load(open(alignment.FIRST))["model"]["vocab"].items()}
    alphabet = alignment.byte_alphabet()

    def bytes_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        a = [(i, bytes(alphabet[c] for c in spelt[i])) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes_b(i)) for i in second.encode(text)]
        whole = (" " + text).encode()
        return (a, b) if b"".join(t for _, t in a) == b"".join(t for _, t in b) == whole else ([], [])

    def groups(a, b):
        out, at, i, j = [], [0, 0], 0, 0
        own = ([], [])
        while i < len(a) or j < len(b):
            if at[0] <= at[1]:
                own[0].append(a[i][0])
                at[0] += len(a[i][1])
                i += 1
            else:
                own[1].append(b[j][0])
                at[1] += len(b[j][1])
                j += 1
            if at[0] == at[1]:
                out.append(own)
                own = ([], [])
        return out

    def run(rows):
        told = [(key, *(t := tokens(text)), groups(*t)) for key, text in rows]
        counts = Counter((g[0][-1], g[1][-1]) for *_, own in told for g in own)
        top = Counter()
        for (_, b), n in counts.items():
            top[b] = max(top[b], n)
        out = []
        for key, a, b, own in told:
            line = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in own)
            links = [(g[0][-1], g[1][-1]) for g in own]
            n_best = sum(counts[x] == top[x[1]] for x in links)
            out.append((key, len(a), len(b), len(own), len(links), n_best, sum(counts[x] for x in links), line))
        return sorted(out, key=repr)

    return run


def test_query_on_whole_table(spark, plain):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    expected = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in plain(rows)]
    got = QUERIES["op11_token_links"](spark, SF).select("doc_id", *NAMES, "groups_sha256")
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected


def test_odd_texts(make_docs, plain):
    rng = random.Random(2)
    letters = "ab cdé ñ ▁́漢字\U0001f600\x00\x7f\t\n<|endoftext|>'s </s>"
    texts = [None, "", " ", "\n", "x", "▁", "a▁b", "<|endoftext|>", "<s> </s> <unk> <0x41>", "é", "é", "ﬁ ﬁ", "﻿x", " "]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    texts += ["word " * 20_000, "é" * 5_000, " " * 5_000 + "x"]
    rows = list(enumerate(texts)) + [(None, "a null id"), (3, "twice"), (3, "twice")]
    got = alignment.aligned(make_docs(rows)).select("doc_id", *NAMES, "groups").collect()
    expected = plain(rows)
    assert sorted(map(tuple, got), key=repr) == expected
    # The odd texts do reach groups of several tokens on either side.
    assert any("," in part.split("|")[0] and "," in part.split("|")[1] for r in expected for part in r[-1].split(";") if "|" in part)


def test_slices_and_batches_do_not_show(spark, make_docs, plain, monkeypatch):
    rows = [(i, f"Number {i} has some wörds, {'und ' * (i % 7)}{'x' * (i % 50)}") for i in range(300)]
    expected = plain(rows)
    monkeypatch.setattr(alignment, "SLICE", 100)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = alignment.aligned(make_docs(rows).repartition(5)).select("doc_id", *NAMES, "groups").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(map(tuple, got), key=repr) == expected


@pytest.mark.parametrize("text", [" " * 1_000_000 + "x", "\n" * 1_000_000, "a" * 1_000_000, "=" * 1_000_000])
def test_very_long_runs(text):
    both = alignment.pair()
    got = both.align([text, "after"], tally := alignment.np.zeros(len(both.bytes_a), alignment.np.int64))
    n_groups = got["n_groups"].to_pylist()
    assert min(n_groups) > 0 and tally.sum() <= sum(n_groups)


def test_the_faster_encoder_gives_the_same_ids():
    both, rng = alignment.pair(), random.Random(4)
    letters = " \t\n\r'sdtvelm.,!?09²½aBéÿ×÷ªǀ" + "".join(map(chr, range(0x20, 0x7F))) + "".join(map(chr, range(0xA1, 0x250)))
    texts = ["".join(rng.choice(letters[: rng.choice((12, 30, len(letters)))]) for _ in range(rng.randrange(80))) for _ in range(3000)]
    texts += [" \u00a0x", "a\x85 b", "\x1c \x1f", "“it’s”", "<|endoftext|>", " " * 999 + "x", " " * 1001 + "x", "a" * 3000]
    whole = [e.ids for e in both.first.encode_batch(texts, add_special_tokens=False)]
    assert both.first_ids(texts) == whole and sum(bool(alignment.PLAIN.fullmatch(t)) for t in texts) > 2900


def test_other_columns(make_docs):
    docs = make_docs([(1, "one two", "en"), (2, None, "de")]).withColumns(
        {"n_a": F.lit("clash"), "_row": F.lit("clash"), "when": F.lit("03:04:05.123456"), "a.b": F.lit(1)}
    )
    got = alignment.aligned(docs)
    assert got.count() == 2 and {"lang", "when", "a.b"} <= set(got.columns)
    assert {r["doc_id"]: (r["n_a"], r["groups"] == "") for r in got.collect()} == {1: (2, False), 2: (0, True)}
    assert alignment.aligned(make_docs([])).count() == 0
