"""Numbered reports from categorised announcements."""

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from filingloom.functions.categories import report_code
from filingloom.functions.dates import datecode, period_start, render, timestamp
from filingloom.functions.fiscal import base_report_id, fiscal_quarter, fiscal_year, report_id
from filingloom.functions.text import non_empty, without_last_part
from filingloom.operators.keys import only_keys, without_keys
from filingloom.operators.numbering import MAX_GROUP_ROWS, number_within
from filingloom.operators.shape import optional
from filingloom.rules import REPORT_CODES
from filingloom.schemas import SYMBOLMAP

# What a report is known by. News ids come first: rows are sorted by these, and few differ in the type alone.
REPORTED_BY = ["news_id", "category"]
# Lots of companies whose rows are counted to bound those of a base id.
COMPANY_BUCKETS = 8192


def report_candidates(
    announcements: DataFrame, codes: dict[str, str] = REPORT_CODES
) -> DataFrame:
    """Announcements of the report types."""
    return announcements.where(F.col("category").isin(list(codes)))


def new_reports(
    candidates: DataFrame,
    stored: DataFrame,
    literal_no_op: bool = False,
    narrow_first: bool = False,
) -> DataFrame:
    """Candidates, one row per news id, without a stored report of their type.

    ``literal_no_op`` compares news ids with report ids, which excludes nothing; it exists to
    reproduce runs made that way.
    """
    if literal_no_op:
        return candidates
    reported = stored.select("news_id", F.col("report_type").alias("category"))
    return without_keys(candidates, reported, REPORTED_BY, narrow_first, unique=True)


def _distinct_ids(stored: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """Distinct stored report ids with their base ids, which are taken from the ids after these have moved."""
    base = without_last_part(F.col("report_id")).alias("base_report_id")
    ids = stored.where(non_empty(F.col("report_id"))).select("report_id")
    if wanted is not None:
        ids = only_keys(ids.select("report_id", base), wanted, "base_report_id").select("report_id")
    return ids.distinct().select("report_id", base)


def existing_counts(
    stored: DataFrame,
    since: str | datetime | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Stored report ids per base id: ``base_report_id, n``.

    ``since`` looks at later reports only; ``wanted`` at the base ids it holds, before any shuffle.
    """
    if since is not None:
        stored = stored.where(F.col("dt_tm") >= render(timestamp(since)))
    ids = _distinct_ids(stored, wanted)
    return ids.groupBy("base_report_id").agg(F.count(F.lit(1)).alias("n"))


def taken_numbers(stored: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Numbers used up per base id: ``base_report_id, n``.

    ``n`` is the count of stored report ids, or the highest number among them if that is more, as it
    is once reports have been removed.
    """
    last_part = F.substring_index("report_id", "_", -1)
    last = F.regexp_extract(last_part, "([0-9]{1,18})$", 1).try_cast("bigint")
    counted = _distinct_ids(stored, wanted).groupBy("base_report_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(last).alias("highest")
    )
    return counted.select("base_report_id", F.greatest("n", F.coalesce("highest", F.lit(0))).alias("n"))


def with_base_report_id(candidates: DataFrame, codes: dict[str, str] = REPORT_CODES) -> DataFrame:
    """Add ``base_report_id``; NULL when the company is unknown."""
    code = report_code(F.col("category"), codes)
    return candidates.withColumn(
        "base_report_id", base_report_id(F.col("company"), code, F.col("dt"))
    )


def number_reports(
    candidates: DataFrame,
    counts: DataFrame,
    max_group_rows: int = MAX_GROUP_ROWS,
    rows_at_most: int | None = None,
    given: str | None = None,
) -> DataFrame:
    """Add ``count`` and ``report_id``, continuing after the stored counts, in filing order.

    Rows with a number in the column ``given`` keep it.
    """
    numbered = number_within(
        candidates,
        "base_report_id",
        ["dt", "news_id"],
        counts,
        max_group_rows=max_group_rows,
        rows_at_most=rows_at_most,
        given=given,
    )
    return numbered.withColumn("report_id", report_id(F.col("base_report_id"), F.col("count")))


def _with_own_numbers(candidates: DataFrame, own: DataFrame) -> DataFrame:
    """Add ``_own_number`` and ``_own_id``: those of a candidate in ``own``, under the same base id; else NULL.

    They are looked up by type and news id, the layout in which reported candidates were left out, so
    that the candidates don't move once more; the one under the base id is picked from the few found.
    """
    base = without_last_part(F.col("report_id"))
    made = (
        own.where(F.col("news_id").isNotNull())
        .select(
            "news_id",
            F.col("report_type").alias("category"),
            F.struct("count", "report_id", base.alias("base")).alias("_made"),
        )
        .groupBy(REPORTED_BY)
        .agg(F.collect_set("_made").alias("_made"))
    )
    same = F.filter("_made", lambda row: row["base"] == F.col("base_report_id"))
    return (
        candidates.join(made, REPORTED_BY, "left")
        .withColumn("_own", F.array_min(same))
        .withColumns({"_own_number": F.col("_own.count"), "_own_id": F.col("_own.report_id")})
        .drop("_made", "_own")
    )


def _largest_group(based: DataFrame, enough: int) -> int:
    """A base id has at most so many rows; what is left out later only makes groups smaller.

    The rows of a base id are of one company, so the largest of ``COMPANY_BUCKETS`` lots of companies will
    do if it has no more than ``enough``: a sum of few numbers. Else base ids are counted.
    """
    bucket = F.pmod(F.xxhash64("company"), F.lit(COMPANY_BUCKETS))
    lots = based.where(F.col("company").isNotNull()).groupBy(bucket.alias("_bucket")).count()
    largest = lots.agg(F.max("count")).first()[0] or 0
    if largest <= enough:
        return largest
    sizes = based.where(F.col("base_report_id").isNotNull()).groupBy("base_report_id").count()
    return sizes.agg(F.max("count")).first()[0] or 0


def build_reports(
    announcements: DataFrame,
    stored: DataFrame,
    as_of: str | datetime | None = None,
    *,
    since: str | datetime | None = None,
    codes: dict[str, str] = REPORT_CODES,
    literal_no_op: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
    narrow_first: bool = False,
    literal_count: bool = False,
    own: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Reports the announcements give rise to, numbered after the stored ones.

    Numbers go on after the stored count or the highest stored number, whichever is more;
    ``literal_count``, or ``since``, makes it the count alone. ``own`` holds reports that the same
    batch has made before: those it makes again keep their number, and none of their numbers is given
    to another. ``counts`` hands in the numbers taken (``base_report_id, n``), ``own`` ones included, so
    that stored reports are not counted.

    ``announcements`` is counted first and, if it is large, read again for the most rows of a base id,
    before any join, so hand in a stored table, whose count is in its file footers, rather than a long
    computation. ``as_of``
    becomes ``document_date``; without it the time of the query counts. ``narrow_first`` suits few
    announcements against many stored reports.
    """
    based = with_base_report_id(report_candidates(announcements, codes), codes)
    candidates = new_reports(based, stored, literal_no_op, narrow_first)
    wanted = based if narrow_first else None
    used = stored
    if own is not None:
        counted = ["report_id"] if since is None else ["report_id", "dt_tm"]
        used = stored.select(*counted).unionByName(own.select(*counted))
    if counts is not None:
        pass
    elif literal_count or since is not None:
        counts = existing_counts(used, since, wanted)
    else:
        counts = taken_numbers(used, wanted)
    if own is not None:
        candidates = _with_own_numbers(candidates, own)
    rows_at_most = announcements.count()
    if rows_at_most > max_group_rows:
        rows_at_most = _largest_group(based, max_group_rows)
    given = None if own is None else "_own_number"
    numbered = number_reports(candidates, counts, max_group_rows, rows_at_most, given)
    if own is not None:
        numbered = numbered.withColumn("report_id", F.coalesce("_own_id", "report_id"))
    made = render(timestamp(as_of) if as_of is not None else F.localtimestamp())
    dt = F.col("dt")
    return numbered.select(
        "company",
        optional(numbered, "symbolmap", SYMBOLMAP).alias("symbolmap"),
        optional(numbered, "news_id").alias("news_id"),
        datecode(dt).alias("datecode"),
        fiscal_year(dt).alias("Year"),
        fiscal_quarter(dt).alias("Qtr"),
        render(dt).alias("dt_tm"),
        optional(numbered, "ATTACHMENTURL").alias("url"),
        "report_id",
        optional(numbered, "NewsBody").alias("report_line"),
        "count",
        made.alias("document_date"),
        period_start(dt, "quarter").alias("quarter_start"),
        F.col("category").alias("report_type"),
    )
