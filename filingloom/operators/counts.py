"""Counts reported about a run."""

from pyspark.sql import Column, DataFrame, functions as F

from filingloom.functions.dates import parse_trade_date
from filingloom.functions.text import strip, without_last_chars
from filingloom.operators.announcements import ATTACHMENT_SUFFIX
from filingloom.operators.keys import distinct_keys


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def counts_with_total(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, and one row for the total: ``is_total`` tells it from the row of NULLs."""
    is_total = F.grouping(column).cast("int").alias("is_total")
    return df.rollup(column).agg(F.count(F.lit(1)).alias("n"), is_total)


def run_metrics(raw: DataFrame, master: DataFrame, stored_ids: DataFrame) -> DataFrame:
    """What becomes of the rows offered to a run, as one row of counts.

    ``no_attachment`` and ``unknown_company`` are left out first. Of the listed rest, ``bad_date``
    rows have no valid date, ``repeated`` rows share their id with another listed one, and
    ``stored_before`` ids are stored already.
    """
    name = strip(F.col("AttachmentName"))
    rows = raw.select(
        strip(F.col("SCRIP_CD")).alias("_code"),
        F.coalesce(name.endswith(ATTACHMENT_SUFFIX), F.lit(False)).alias("attached"),
        without_last_chars(name, len(ATTACHMENT_SUFFIX)).alias("news_id"),
        parse_trade_date(strip(F.col("Tradedate"))).isNotNull().alias("dated"),
    )
    codes = master.select(F.col("SCRIP_CD").alias("_code"), F.lit(True).alias("known"))
    listed = F.col("attached") & F.coalesce("known", F.lit(False))
    ids = (
        rows.join(codes, "_code", "left")
        .groupBy(F.when(listed, F.col("news_id")).alias("news_id"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(~F.col("attached")).alias("no_attachment"),
            F.count_if(F.col("attached") & ~listed).alias("unknown_company"),
            F.count_if(listed & ~F.col("dated")).alias("bad_date"),
        )
    )
    known = distinct_keys(stored_ids, "news_id").withColumn("stored", F.lit(True))
    is_id = F.col("news_id").isNotNull()

    def total(column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")

    return ids.join(known, "news_id", "left").agg(
        total("n").alias("offered"),
        total("no_attachment").alias("no_attachment"),
        total("unknown_company").alias("unknown_company"),
        total("bad_date").alias("bad_date"),
        total(F.when(is_id, F.col("n") - 1)).alias("repeated"),
        F.count_if(is_id & F.col("stored").isNotNull()).alias("stored_before"),
    )


def insert_metrics(batch: DataFrame, stored: DataFrame, key: str = "news_id") -> DataFrame:
    """What appending ``batch`` under a unique key does: total, inserted and duplicate rows."""
    per_key = batch.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = distinct_keys(stored, key).withColumn("stored", F.lit(True))
    return (
        per_key.join(known, key, "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.count_if(F.col("stored").isNull()).alias("inserted"),
        )
        .withColumn("duplicates", F.col("total") - F.col("inserted"))
    )
