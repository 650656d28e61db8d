"""Token counts: an exact histogram of encoded lengths and what suffix sums tell from it.

A public tokenizer encodes every whole text; documents are aggregated by length, and every later
question is answered from the histogram alone.

Defined cases: NULL and empty texts have length 0; runs of white space may have any length; repeated rows count each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from filingloom.sinks.workspace import checkpointed

#: Folder of the public vocabularies and the one used unless another is named.
TOKENIZERS = "/opt/tokenizers"
RANKS = "byte_bpe_50k.tiktoken"
#: How this byte-level vocabulary splits text before merging (fixed value of the public tokenizer).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A longer run of white space is counted by itself: finding where it ends would exhaust the splitter's stack.
LONG_RUN = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")
#: Lengths in one block of the two-step suffix sums.
BLOCK = 256


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str = PATTERN):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str, path: str = f"{TOKENIZERS}/{RANKS}") -> int:
    """Tokens of a text.

    The pattern takes a run of white space as one piece, without its last character if something else
    follows. So a text is cut there, and a long run goes through a splitter that looks at nothing else.
    """
    total, at = 0, 0
    for run in LONG_RUN.finditer(text):
        end = run.end() - (run.end() < len(text))
        total += len(encoding(path).encode_ordinary(text[at : run.start()]))
        total += len(encoding(path, r"\s+").encode_ordinary(text[run.start() : end]))
        at = end
    return total + len(encoding(path).encode_ordinary(text[at:]))


def token_count(text: Column, path: str = f"{TOKENIZERS}/{RANKS}") -> Column:
    """Tokens of a text; 0 for NULL. ``path`` must exist on every executor."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: count_tokens(t, path))

    return F.pandas_udf(count, "long")(F.coalesce(text, F.lit("")))


def length_histogram(docs: DataFrame, path: str = f"{TOKENIZERS}/{RANKS}") -> DataFrame:
    """(length, n_docs): how many documents have each encoded length."""
    return docs.select(token_count(F.col("text"), path).alias("length")).groupBy("length").agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """The histogram with sums over all lengths from each row's length on, and up to it.

    ``docs_from``, ``tokens_from``: documents at least this long and their tokens; ``docs_to``,
    ``tokens_to``: at most this long. Sums run in two steps, over blocks of lengths and inside each
    block, so no task gets more rows than a block has lengths or than there are blocks.
    """
    rows = histogram.withColumn("_block", F.floor(F.col("length") / block)).withColumn(
        "n_tokens", F.col("length") * F.col("n_docs")
    )
    blocks = rows.groupBy("_block").agg(F.sum("n_docs").alias("_docs"), F.sum("n_tokens").alias("_tokens"))
    over = Window.orderBy("_block")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    after = over.rowsBetween(1, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    around = blocks.select(
        "_block",
        F.coalesce(F.sum("_docs").over(before), zero).alias("_docs_before"),
        F.coalesce(F.sum("_tokens").over(before), zero).alias("_tokens_before"),
        F.coalesce(F.sum("_docs").over(after), zero).alias("_docs_after"),
        F.coalesce(F.sum("_tokens").over(after), zero).alias("_tokens_after"),
    )
    inside = Window.partitionBy("_block").orderBy("length")
    up = inside.rowsBetween(Window.unboundedPreceding, 0)
    on = inside.rowsBetween(0, Window.unboundedFollowing)
    return rows.join(around, "_block").select(
        "length",
        "n_docs",
        "n_tokens",
        (F.sum("n_docs").over(on) + F.col("_docs_after")).alias("docs_from"),
        (F.sum("n_tokens").over(on) + F.col("_tokens_after")).alias("tokens_from"),
        (F.sum("n_docs").over(up) + F.col("_docs_before")).alias("docs_to"),
        (F.sum("n_tokens").over(up) + F.col("_tokens_before")).alias("tokens_to"),
    )


def context_report(sums: DataFrame) -> DataFrame:
    """For every length as a context limit: documents cut, tokens kept and lost, and the rank share.

    A limit between two lengths keeps ``tokens_to`` of the lower one plus the limit times
    ``docs_from`` of the upper one; see :func:`kept_tokens`.
    """
    cut = F.col("docs_from") - F.col("n_docs")
    kept = F.col("tokens_to") + F.col("length") * cut
    whole = F.col("tokens_to") + F.col("tokens_from") - F.col("n_tokens")
    return sums.select(
        "*",
        cut.alias("docs_cut"),
        kept.alias("tokens_kept"),
        (whole - kept).alias("tokens_lost"),
        (F.col("docs_to") / (F.col("docs_to") + cut)).alias("docs_share"),
    )


def kept_tokens(sums: DataFrame, limit: int) -> int:
    """Tokens left if every document is cut at ``limit``."""
    low = F.max(F.struct("length", "tokens_to"))
    at = sums.filter(F.col("length") <= limit).agg(low.alias("low")).first()["low"]
    up = sums.filter(F.col("length") > limit).agg(F.min(F.struct("length", "docs_from")).alias("up")).first()["up"]
    return (at["tokens_to"] if at else 0) + limit * (up["docs_from"] if up else 0)


def quantile(sums: DataFrame, share: float) -> int | None:
    """The least length that at least ``share`` of all documents do not exceed."""
    total = F.col("docs_to") + F.col("docs_from") - F.col("n_docs")
    return sums.filter(F.col("docs_to") >= F.lit(share) * total).agg(F.min("length")).first()[0]


def summed(docs: DataFrame, path: str = f"{TOKENIZERS}/{RANKS}") -> DataFrame:
    """Encode once, keep the histogram, and answer from it."""
    return suffix_sums(checkpointed(length_histogram(docs, path)))
