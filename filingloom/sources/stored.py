"""Stored announcements and reports."""

from collections.abc import Callable
from datetime import datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from filingloom.functions.dates import day_start, render, timestamp
from filingloom.operators.keys import distinct_keys, only_keys
from filingloom.operators.reports import report_candidates
from filingloom.rules import REPORT_CODES
from filingloom.sinks.workspace import child_folders, path_exists


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows. Spark sees that while planning and drops the joins with it."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).where(F.lit(False)).select(*columns)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, read afresh; empty while nothing has been written."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return empty_table(spark, schema)


def read_partitions(
    spark: SparkSession, path: str, schema: T.StructType, column: str, wanted: Callable[[str], bool]
) -> DataFrame:
    """The part of a stored table whose first partition column has a wanted value, as text.

    Folders of that column are listed by name, one level deep; only wanted ones are looked into.
    """
    prefix = f"{column}="
    names = [n for n in child_folders(spark, path) if n.startswith(prefix)]
    paths = [f"{path}/{n}" for n in names if wanted(n.removeprefix(prefix))]
    if not paths:
        return empty_table(spark, schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def since_day(df: DataFrame, since: str | datetime | None, column: str = "dt") -> DataFrame:
    """Rows from the midnight of ``since`` on; all rows when it is ``None``."""
    return df if since is None else df.where(F.col(column) >= day_start(timestamp(since)))


def existing_news_ids(announcements: DataFrame, since: str | datetime | None = None) -> DataFrame:
    """Distinct non-empty news ids stored since a day."""
    return distinct_keys(since_day(announcements, since), "news_id")


def existing_report_ids(
    reports: DataFrame, report_type: str | None = None, since: str | datetime | None = None
) -> DataFrame:
    """Distinct non-empty report ids, of one type and since a day if asked."""
    if report_type is not None:
        reports = reports.where(F.col("report_type") == report_type)
    if since is not None:
        reports = reports.where(F.col("dt_tm") >= render(day_start(timestamp(since))))
    return distinct_keys(reports, "report_id")


def recheck_start(
    as_of: str | datetime, days: int | None, earliest: str | datetime | None = None
) -> datetime | None:
    """Midnight ``days`` days before ``as_of``, or of ``earliest`` without a number of days.

    ``None`` if there is neither: all history.
    """
    if days is None and earliest is None:
        return None
    start = datetime.fromisoformat(str(earliest if days is None else as_of))
    return datetime.combine(start.date() - timedelta(days=days or 0), time())


def recheck_scan(
    announcements: DataFrame,
    as_of: str | datetime,
    days: int | None,
    earliest: str | datetime | None = None,
    codes: dict[str, str] = REPORT_CODES,
) -> DataFrame:
    """Announcements of the report types from ``days`` days before ``as_of``, or since ``earliest``.

    With neither, all of them.
    """
    return report_candidates(since_day(announcements, recheck_start(as_of, days, earliest)), codes)


def stored_rows_of(
    reports: DataFrame, ids: DataFrame, key: str = "news_id", row_id: str = "row_id"
) -> DataFrame:
    """Row id and key of the stored rows with a listed key."""
    return only_keys(reports, ids, key).select(row_id, key)
