"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: A table is sent to every executor only if it was measured to be no larger than this.
BROADCAST_BYTES = 16 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for NULL."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def broadcast_if_small(df: DataFrame, *text_columns: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a table for broadcast if its measured size allows it; else leave the join to Spark.

    The measure is the bytes of the named text columns and 16 bytes for each value. Results are the
    same either way; without the mark Spark sorts and merges and may split crowded keys.
    """
    texts = sum((F.octet_length(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in text_columns), F.lit(0))
    width = 16 * len(df.columns)
    size = df.agg(F.coalesce(F.sum(texts + F.lit(width)), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= limit else df
