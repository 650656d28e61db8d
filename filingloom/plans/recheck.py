"""Recheck: give stored announcements of the last days the reports they lack."""

from datetime import datetime

from pyspark.sql import SparkSession

from filingloom.plans.ingest import Store, store_reports
from filingloom.rules import REPORT_CODES
from filingloom.sources.stored import recheck_scan, recheck_start

# Fixed value: days a recheck looks back.
RECHECK_DAYS = 5


def recheck(
    spark: SparkSession,
    store: Store,
    batch: str,
    as_of: str | datetime,
    *,
    days: int | None = RECHECK_DAYS,
    earliest: str | datetime | None = None,
    codes: dict[str, str] = REPORT_CODES,
) -> int:
    """Reports written for announcements of the last ``days`` days.

    ``days=None`` takes those since ``earliest``, and all history without it.
    """
    announcements = store.announcements(spark, recheck_start(as_of, days, earliest))
    rows = recheck_scan(announcements, as_of, days, earliest, codes)
    return store_reports(rows, store, batch, as_of, codes=codes)
