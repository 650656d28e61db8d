import base64
import hashlib
import re
import zlib

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from filingloom.llm import secrets
from filingloom.llm.queries import QUERIES

ASSIGN = re.compile(
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
BASE = [("assign", ASSIGN, lambda m: len(m[1]) >= 8), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16)]
BASE.append(("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32))


def plain(text):
    found = [(m.start(), i, m.end()) for i, (_, p, keep) in enumerate(BASE) for m in p.finditer(text) if keep(m)]
    return [(BASE[i][0], a, b) for a, i, b in sorted(found)]


def base_of(spans):
    return [s for s in spans if s[0] in ("assign", "access", "hex")]


PIECES = ["password", "PASSWD", "secret", "token", "api_key", "ApiKey", "=", ": ", "\"", "'", " ", "AKIA", "akia", "ABCD1234WXYZ"]
PIECES += ["deadbeef" * 4, "0123abcd", "é", "ſ", "K", "\U0001f600", "longvalue99", "-._", "\n", "ghp_", "x" * 5]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_base_spans_equal_a_plain_search(pieces):
    text = "".join(pieces)
    assert base_of(secrets.Scanner().spans(text)) == plain(text)


def checked_token(prefix="ghp_", body="A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"):
    alphabet = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, d = divmod(value, 62)
        digits = alphabet[d] + digits
    return prefix + body + digits.rjust(6, "0")


def test_checksum_decides():
    good = checked_token()
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    text = f"é {good} and {bad}"
    assert secrets.Scanner().spans(text) == [("crc_token", 2, 2 + len(good))]
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9P"
    assert secrets.Scanner().spans(jwt)[0][0] == "web_token"
    assert secrets.Scanner().spans("eyJub3QganNvbiBhdA.eyJhYmNkZWZnaGlq.aaaaaaaaaaaaaaaaaaaa") == []


def test_query_on_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op4_secret_spans"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        spans, r = plain(text or ""), got[doc_id]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        assert {s for s in listed.split(",") if s} <= set(r["spans"].split(","))


def test_edges_and_redaction(make_docs):
    rows = [(1, None), (1, ""), (None, "token=abcdefgh1 x"), (2, "a" * 100_000 + " secret: zzzzzzzzz"), (2, "clean text")]
    docs = make_docs(rows).withColumn("spans", F.lit("clash"))
    found = secrets.with_spans(docs)
    assert found.columns == docs.columns and found.count() == 5
    clean = {(r["doc_id"], r["text"]): r for r in secrets.redacted(docs).collect()}
    assert (1, None) in clean and (2, "clean text") in clean and (None, "[assign] x") in clean
    assert clean[(None, "[assign] x")]["n_chars"] == 10
    assert secrets.with_spans(make_docs([])).count() == 0
    assert secrets.redacted(make_docs([])).count() == 0


def test_overlapping_spans_go_together():
    assert secrets.redact("abcdefgh", [("x", 1, 5), ("y", 3, 7)]) == "a[x]h"


def test_a_header_nested_too_deeply_is_no_web_token():
    def token(header):
        return base64.urlsafe_b64encode(header.encode()).decode().rstrip("=") + ".eyJhYmNkZWZnaGlq." + "s" * 20

    deep = token('{"a":' + "[" * 20_000 + "]" * 20_000 + ',"alg":1}')
    plain = token('{"alg":"HS256","typ":"JWT"}')
    found = secrets.Scanner().spans(f"{deep} {plain}")
    assert [k for k, *_ in found] == ["web_token"] and found[0][1] == len(deep) + 1
