"""Secret scans: keyword automaton, regular expressions anchored at its hits, checksum validation.

One pass of an Aho-Corasick automaton over the lower-cased bytes of a text finds keywords; a pattern is
tried only at the hits of its keyword, from left to right and never inside its last match, which is what
a leftmost search without overlaps gives. Kinds with an embedded checksum keep a match only if the
checksum holds. Runs of hexadecimal digits have no keyword; they are found by their pattern.

Defined cases: NULL text is empty and has no spans; rows that repeat are scanned on their own; an empty
table gives no rows; other columns pass through.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc_suffix(match: re.Match) -> bool:
    """The last six characters are the CRC-32 of the random part, in base 62 with leading zeros."""
    body = match[0].split(b"_", 1)[1]
    value, digits = zlib.crc32(body[:-6]), bytearray()
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits.append(_BASE62[digit])
    return bytes(reversed(digits)) == body[-6:]


def _json_header(match: re.Match) -> bool:
    """The first part of a web token decodes to a JSON object that names an algorithm.

    One nested too deeply for the parser is no header.
    """
    part = match[0].split(b".", 1)[0]
    try:
        header = json.loads(base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(header, dict) and "alg" in header


@dataclass(frozen=True)
class Kind:
    """A kind of secret. ``keywords`` (lower case) begin every match; without any, the pattern is searched."""

    name: str
    keywords: tuple[str, ...]
    pattern: bytes
    keep: Callable[[re.Match], bool]


#: In the order in which spans of equal start are listed.
BASE_KINDS = (
    Kind(
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        lambda m: len(m[1]) >= 8,
    ),
    Kind("access", ("akia",), rb"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    Kind("hex", (), rb"[0-9a-f]{32,}", lambda m: True),
)
#: Kinds with an embedded check. They add spans to the base ones.
CHECKED_KINDS = (
    Kind("crc_token", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"), rb"(?:gh[pousr]|npm)_[0-9A-Za-z]{36}(?![0-9A-Za-z])", _crc_suffix),
    Kind("web_token", ("eyj",), rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}", _json_header),
)
KINDS = BASE_KINDS + CHECKED_KINDS

SCHEMA = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
    )
)


class Scanner:
    """Finds the spans of all kinds in a text; build one per task."""

    def __init__(self, kinds: tuple[Kind, ...] = KINDS):
        import ahocorasick

        self.kinds = kinds
        self.patterns = [re.compile(k.pattern) for k in kinds]
        self.automaton = ahocorasick.Automaton()
        users: dict[str, list[int]] = {}
        for i, kind in enumerate(kinds):
            for word in kind.keywords:
                users.setdefault(word, []).append(i)
        for word, owners in users.items():
            self.automaton.add_word(word, (len(word), tuple(owners)))
        self.automaton.make_automaton()
        self.searched = [i for i, kind in enumerate(kinds) if not kind.keywords]

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, end exclusive, by start and order of kinds."""
        raw = text.encode("utf-8", "surrogatepass")
        # Latin-1 keeps one sign per byte, so hits are byte positions; lower() of bytes changes A-Z only.
        hits = [
            (end - length + 1, owners)
            for end, (length, owners) in self.automaton.iter(raw.lower().decode("latin-1"))
        ]
        hits.sort()
        free = [0] * len(self.kinds)
        found = []
        for start, owners in hits:
            for i in owners:
                if start >= free[i] and (m := self.patterns[i].match(raw, start)):
                    free[i] = m.end()
                    if self.kinds[i].keep(m):
                        found.append((start, i, m.end()))
        for i in self.searched:
            found.extend((m.start(), i, m.end()) for m in self.patterns[i].finditer(raw) if self.kinds[i].keep(m))
        found.sort()
        if len(raw) == len(text):
            return [(self.kinds[i].name, start, end) for start, i, end in found]
        spans, at, points = [], 0, 0
        for start, i, end in found:
            points += _points(raw, at, start)
            at = start
            spans.append((self.kinds[i].name, points, points + _points(raw, start, end)))
        return spans


def _points(raw: bytes, start: int, end: int) -> int:
    return len(raw[start:end].decode("utf-8", "surrogatepass"))


def with_spans(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, column: str = "spans") -> DataFrame:
    """Add an array of (kind, start, end) to every row; the text itself is read once, in place."""

    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(kinds)
        for texts in batches:
            yield pd.Series(
                [[dict(zip(("kind", "start", "end"), s)) for s in scanner.spans(t or "")] for t in texts],
                index=texts.index,
                dtype=object,
            )

    scan = F.pandas_udf(find, SCHEMA)
    return docs.withColumn(column, scan(F.coalesce(F.col("text"), F.lit(""))))


def redacted(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Replace every span by ``[kind]``; rows without a span stay as they are.

    Spans that overlap are replaced together, under the kind that starts first. ``n_chars`` follows the
    new text if the column exists.
    """
    columns = docs.columns

    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(kinds)
        for texts in batches:
            yield texts.map(lambda t: None if t is None else redact(t, scanner.spans(t)))

    cleaned = docs.withColumn("_clean", F.pandas_udf(clean, "string")(F.col("text")))
    changed = ~F.col("_clean").eqNullSafe(F.col("text"))
    if "n_chars" in columns:
        count = F.char_length("_clean").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(changed, count).otherwise(F.col("n_chars")))
    return cleaned.withColumn("text", F.col("_clean")).select(*columns)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def listed(spans, names: set[str] | None = None) -> str:
    """kind:start:end of the spans, joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans if names is None or k in names)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
