"""Cross-tokenizer alignment: which tokens of one vocabulary end where tokens of another one end.

Two tokenizers encode the same bytes, a space and the text. Places where a token of each ends cut both
sequences into groups; the last tokens of a group are linked. Most groups are one token on either side,
and then both have the same bytes. So a table made once from the vocabularies, from each id of the first
to the id of the second with the same bytes, names the other end of such a link, and links of that kind
are counted in a vector as long as the first vocabulary, one for each task, summed afterwards.
Only links of other groups are shuffled as pairs of ids.

Texts are encoded once. What a document needs later is written: the ids that the table answers for, and
its other pairs with how often it has them. Counts of the first kind come back as one vector (its length
is the vocabulary's), counts of pairs by a join that adaptive execution can split.

Defined cases: texts that are NULL or empty, and those of which either tokenizer does not give back every
byte, have no tokens; strings of special tokens are plain text; rows that repeat count each; rows with a
NULL id take part; an empty table gives no rows; other columns pass through, those named as a result are
replaced. Vocabulary files must be at the same path on every executor,
and the first one is byte-level BPE split as ``PATTERN`` says.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from filingloom.llm.common import broadcast_if_small
from filingloom.llm.lengths import PATTERN
from filingloom.sinks.workspace import staged

TOKENIZERS = "/opt/tokenizers"
FIRST, SECOND = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
#: Bytes of text encoded at once: what is held besides a batch of rows.
SLICE = 1 << 19
#: Texts of these characters alone, without a longer run of white space, go through a faster encoder of the
#: same merges. What letters, numbers and spaces are is the same in all editions of Unicode for them.
PLAIN, RUN = re.compile(r"[\t\n\r\x20-\x7e\u00a1-\u024f]*"), re.compile(r"[\t\n\r ]{1000}")
#: Rows whose counts are added up at once.
ROWS = 512
#: Ids are below this; a pair of ids is one number.
IDS = 1 << 20
SPACE = "▁"


def byte_alphabet() -> dict[str, int]:
    """Characters by which byte-level vocabularies write bytes: itself if printable, else 256 and so on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, the bytes of their tokens, and the table of same bytes."""

    def __init__(self, first: str, second: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.first = Tokenizer.from_file(first)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        alphabet = byte_alphabet()
        plain = self.first.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (1 + max(self.first.get_vocab().values()))
        for token, i in plain.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token)
        self.bytes_b = [self._piece(i) for i in range(self.second.get_piece_size())]
        if max(len(self.bytes_a), len(self.bytes_b)) > IDS:
            raise ValueError(f"a vocabulary has more than {IDS} ids")
        # A byte's own token is used only where no piece has that byte.
        known = {self.bytes_b[i]: i for i in sorted(range(len(self.bytes_b)), key=lambda i: not self.second.is_byte(i))}
        self.same = np.array([known.get(b, -1) if b else -1 for b in self.bytes_a])
        self.length_a = np.array(list(map(len, self.bytes_a)))
        self.length_b = np.array(list(map(len, self.bytes_b)))
        a, b = range(len(self.bytes_a)), range(len(self.bytes_b))
        self.quick = self._quick(first)
        # How a token is written in the line of groups, inside its part and at the end of it.
        self.spelt = [*(f"{i}," for i in a), *(f"{i}|" for i in a), *(f"{i}," for i in b), *(f"{i};" for i in b)]

    def _piece(self, i: int) -> bytes:
        if self.second.is_control(i) or self.second.is_unknown(i):
            return b""
        piece = self.second.id_to_piece(i)
        if self.second.is_byte(i):
            return bytes([int(re.fullmatch(r"<0x([0-9A-F]{2})>", piece)[1], 16)])
        return piece.replace(SPACE, " ").encode()

    def _quick(self, path: str):
        """The first vocabulary in a faster encoder, if its ids are in the order of its merges."""
        import tiktoken

        with open(path, encoding="utf-8") as lines:
            model = json.load(lines)["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
            return None
        ranks = {token: i for i, token in enumerate(self.bytes_a) if token}
        return tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def first_ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of the first tokenizer."""
        quick = [self.quick is not None and bool(PLAIN.fullmatch(t)) and not RUN.search(t) for t in texts]
        rest = iter(self.first.encode_batch_fast([t for t, q in zip(texts, quick) if not q], add_special_tokens=False))
        return [self.quick.encode_ordinary(t) if q else next(rest).ids for t, q in zip(texts, quick)]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both for each text; none where bytes are not given back."""
        spaced = [" " + t for t in texts]
        a, b = self.first_ids(spaced), self.second.encode(texts, num_threads=1)
        for i, text in enumerate(spaced):
            whole = text.encode()
            told = [b"".join(map(held.__getitem__, ids)) for held, ids in ((self.bytes_a, a[i]), (self.bytes_b, b[i]))]
            if len(text) == 1 or told != [whole, whole]:
                a[i], b[i] = [], []
        return a, b

    def align(self, texts: list[str], tally: np.ndarray) -> dict[str, pa.Array]:
        """One value per text; links that the table of same bytes answers for are added to ``tally``."""
        a, b = self.encode(texts)
        n_a, n_b = (np.array(list(map(len, ids)), np.int64) for ids in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(ids), np.int64, n.sum()) for ids, n in ((a, n_a), (b, n_b)))
        # Both sides of a text have the same bytes, so places run on over the texts of a slice.
        ends_a, ends_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        at = np.searchsorted(ends_b, ends_a)
        last_a = np.flatnonzero(ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a) if len(ends_b) else np.zeros(0, np.int64)
        last_b = at[last_a]
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        linked_a, linked_b = ids_a[last_a], ids_b[last_b]
        regular = (size_a == 1) & (size_b == 1) & (self.same[linked_a] == linked_b)
        tally += np.bincount(linked_a[regular], minlength=len(tally))
        text = np.searchsorted(np.cumsum(n_a), last_a, side="right")

        def by_text(values: np.ndarray, own: np.ndarray, kind: pa.DataType) -> pa.Array:
            return pa.ListArray.from_arrays(np.searchsorted(own, np.arange(len(texts) + 1)).astype(np.int32), pa.array(values, kind))

        pair = (linked_a * IDS + linked_b)[~regular]
        order = np.lexsort((pair, text[~regular]))
        own, pair = text[~regular][order], pair[order]
        new = np.ones(len(pair), bool)
        new[1:] = (own[1:] != own[:-1]) | (pair[1:] != pair[:-1])
        times = np.diff(np.flatnonzero(new), append=len(new))
        return {
            "n_a": pa.array(n_a),
            "n_b": pa.array(n_b),
            "n_groups": pa.array(np.bincount(text, minlength=len(texts)), pa.int64()),
            "groups": pa.array(self._lines(ids_a, ids_b, last_a, last_b, n_a + n_b), pa.string()),
            "_same": by_text(linked_a[regular], text[regular], pa.int32()),
            "_pairs": by_text(pair[new], own[new], pa.int64()),
            "_times": by_text(times, own[new], pa.int32()),
        }

    def _lines(self, ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, n: np.ndarray) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        many_a, many_b = len(self.bytes_a), len(self.bytes_b)
        # The table ``spelt`` has four parts; the last token of a part of a group is in the second and the fourth.
        code_a, code_b = ids_a.copy(), ids_b + 2 * many_a
        code_a[last_a] += many_a
        code_b[last_b] += many_b
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        before_b = np.repeat(np.concatenate([[0], last_b + 1])[: len(last_a)], np.diff(last_a, prepend=-1))
        until_a = np.repeat(last_a + 1, np.diff(last_b, prepend=-1))
        codes[np.arange(len(ids_a)) + before_b] = code_a
        codes[np.arange(len(ids_b)) + until_a] = code_b
        words, ends = codes.tolist(), np.cumsum(n).tolist()
        return ["".join(map(self.spelt.__getitem__, words[i:j]))[:-1] for i, j in zip([0, *ends], ends)]


@lru_cache(maxsize=2)
def pair(first: str = FIRST, second: str = SECOND) -> Pair:
    return Pair(first, second)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with about ``SLICE`` bytes of text, at least one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        until = max(at + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
        yield batch.slice(at, until - at)
        at = until


_RESULTS = ("n_a", "n_b", "n_groups", "groups")
_HELD = ("_same", "_pairs", "_times", "_tally")
#: Names that the joins of counts use; columns of them do not pass through.
_OWN = ("_row", "_found", "_sum", "_best")


def encoded(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """Each row without its text, with ``n_a``, ``n_b``, ``n_groups``, the line ``groups``, and what counts need.

    One row of each task has the task's vector of counts, as an array of ids and numbers.
    """
    kept = [c for c in docs.columns if c not in (*_RESULTS, *_HELD, *_OWN, "text")]
    fields = [T.StructField(c, T.LongType()) for c in _RESULTS[:3]]
    fields += [T.StructField("groups", T.StringType()), T.StructField("_same", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField("_pairs", T.ArrayType(T.LongType())), T.StructField("_times", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField("_tally", T.ArrayType(T.LongType()))]
    # Numbered names: a name with a dot can't be read by mapInArrow.
    plain = [f"_{i}" for i in range(len(kept))]
    schema = T.StructType([T.StructField(p, docs.schema[c].dataType) for p, c in zip(plain, kept)] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(first, second)
        tally, waiting = np.zeros(len(both.bytes_a), np.int64), None

        def out(columns: dict[str, pa.Array], counts: list | None) -> pa.RecordBatch:
            rows = len(columns["n_a"])
            columns["_tally"] = pa.array([counts, *[None] * (rows - 1)], pa.list_(pa.int64()))
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for part in _slices(batch):
                if waiting:
                    yield out(waiting, None)
                texts = [t or "" for t in part.column("text").to_pylist()]
                waiting = {p: part.column(p) for p in plain} | both.align(texts, tally)
        if waiting:
            seen = np.flatnonzero(tally)
            yield out(waiting, np.stack([seen, tally[seen]], axis=1).ravel().tolist())

    found = docs.select(*(F.col(f"`{c}`").alias(p) for p, c in zip(plain, kept)), "text").mapInArrow(run, schema)
    return found.toDF(*kept, *(f.name for f in fields))


def pair_counts(held: DataFrame) -> DataFrame:
    """(pair, n): links of each pair of ids that the table of same bytes does not answer for."""
    each = held.select(F.explode(F.arrays_zip("_pairs", "_times")).alias("p"))
    return each.groupBy(F.col("p._pairs").alias("pair")).agg(F.sum(F.col("p._times").cast("long")).alias("n"))


def same_counts(held: DataFrame, size: int) -> np.ndarray:
    """Links by id of the first vocabulary, of those that the table answers for: a vector of its length."""
    places = F.sequence(F.lit(0), F.size("_tally") - 2, F.lit(2))
    each = held.filter(F.size("_tally") > 0).select(
        F.explode(F.transform(places, lambda i: F.struct(F.get("_tally", i).alias("id"), F.get("_tally", i + 1).alias("n")))).alias("t")
    )
    summed = each.groupBy("t.id").agg(F.sum("t.n").alias("n")).toPandas()
    counts = np.zeros(size, np.int64)
    counts[summed["id"].to_numpy(np.int64)] = summed["n"]
    return counts


def with_counts(found: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """Rows of :func:`encoded` with ``n_links``, ``n_best`` and ``count_sum``.

    A link's count is how many links of all rows have its pair of ids; it is best if no pair with the
    same second id has a higher one.
    """
    held = staged(found.select("*", F.monotonically_increasing_id().alias("_row")), "aligned")
    both = pair(first, second)
    same, counts = both.same, same_counts(held, len(both.bytes_a))
    pairs = staged(pair_counts(held), "pairs")
    # Both vectors and the highest counts are as long as a vocabulary.
    top = np.zeros(len(both.bytes_b), np.int64)
    np.maximum.at(top, same[same >= 0], counts[same >= 0])
    second_id = F.col("pair") % IDS
    highest = pairs.groupBy(second_id.alias("id")).agg(F.max("n").alias("n")).toPandas()
    np.maximum.at(top, highest["id"].to_numpy(np.int64), highest["n"].to_numpy(np.int64))
    best = (same >= 0) & (counts == top[np.maximum(same, 0)])

    def told(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            sums: list[list[np.ndarray]] = [[], []]
            for at in range(0, len(lists), ROWS):
                part = lists.slice(at, ROWS)
                ids, until = part.flatten().to_numpy(), np.cumsum(pc.list_value_length(part).to_numpy())
                for out, values in zip(sums, (counts[ids], best[ids])):
                    out.append(np.diff(np.concatenate([[0], np.cumsum(values)])[until], prepend=0))
            whole = [pa.array(np.concatenate([np.zeros(0, np.int64), *out]), pa.int64()) for out in sums]
            yield pa.StructArray.from_arrays(whole, ["count_sum", "n_best"])

    tops = held.sparkSession.createDataFrame(pd.DataFrame({"id": np.arange(len(top)), "top": top}))
    of_pair = pairs.join(F.broadcast(tops), second_id == F.col("id")).select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("best"))
    asked = held.select("_row", F.explode(F.arrays_zip("_pairs", "_times")).alias("p")).select(
        "_row", F.col("p._pairs").alias("pair"), F.col("p._times").cast("long").alias("_times")
    )
    answered = asked.join(broadcast_if_small(of_pair), "pair")
    rest = answered.groupBy("_row").agg(
        F.sum(F.col("n") * F.col("_times")).alias("_sum"), F.sum(F.col("best") * F.col("_times")).alias("_best")
    )
    kept = [F.col(f"`{c}`") for c in held.columns if c not in (*_HELD, *_OWN, "n_links", "n_best", "count_sum")]
    own = held.withColumn("_found", F.arrow_udf(told, "count_sum long, n_best long")("_same"))
    whole = own.select("_row", *kept, "_found").join(rest, "_row", "left")
    return whole.select(
        *kept,
        F.col("n_groups").alias("n_links"),
        (F.col("_found.n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("_found.count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
    )


def aligned(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """Rows of ``docs`` without their text, with the line of groups and all counts."""
    return with_counts(encoded(docs, first, second), first, second)
