"""What to ask for: ranges, day spines, request rows and the days still missing."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from filingloom.functions.dates import (
    datecode,
    day_start,
    days_before,
    minute_start,
    parse_any_date,
    timestamp,
    two_digits,
)

# Bounds of the history, and the days a live run looks at (today included).
HISTORY_MIN = "2023-11-01 00:00:00"
HISTORY_MAX = "2025-10-31 00:00:00"
LIVE_DAYS = 5


def clamp_range(
    df: DataFrame,
    from_col: str = "from_dt",
    to_col: str = "to_dt",
    *,
    earliest: str | datetime,
    latest: str | datetime,
) -> DataFrame:
    """Bring each range inside the history from ``earliest`` to ``latest``.

    A start outside it (or missing) becomes the earliest day, an end outside it (or missing) the
    latest; a reversed range is turned round.
    """
    low, high = timestamp(earliest), timestamp(latest)

    def inside(bound: Column, fallback: Column) -> Column:
        return F.when((bound >= low) & (bound <= high), bound).otherwise(fallback)

    start, end = inside(F.col(from_col), low), inside(F.col(to_col), high)
    return df.withColumns({from_col: F.least(start, end), to_col: F.greatest(start, end)})


def day_spine(
    ranges: DataFrame, from_col: str = "from_dt", to_col: str = "to_dt", into: str = "request_ts"
) -> DataFrame:
    """One row per day from start to end, both included, at the start's time of day."""
    days = F.sequence(F.col(from_col), F.col(to_col), F.expr("interval 1 day"))
    return ranges.where(F.col(from_col) <= F.col(to_col)).withColumn(into, F.explode(days))


def live_spine(
    cursors: DataFrame,
    as_of: str | datetime,
    cursor: str = "cursor",
    live_days: int = LIVE_DAYS,
    literal: bool = False,
    into: str = "request_ts",
) -> DataFrame:
    """Requests of a live run that last caught up at ``cursor`` (a text in any accepted format).

    A cursor later than today's midnight asks once, from there on. Otherwise there is one request
    per day from the cursor's day to today; a missing, invalid or too old cursor starts
    ``live_days - 1`` days ago. ``literal`` keeps the cursor's time of day and counts whole elapsed
    days only, which leaves today out when the cursor is not at midnight.
    """
    today = day_start(timestamp(as_of))
    window_start = days_before(timestamp(as_of), live_days - 1)
    last = parse_any_date(F.col(cursor))
    start = F.when(last >= window_start, last).otherwise(window_start)
    first = F.least(start if literal else day_start(start), today)
    days = F.sequence(first, today, F.expr("interval 1 day"))
    plan = F.when(start > today, F.array(start)).otherwise(days)
    return cursors.withColumn(into, F.explode(plan))


def next_cursor(run_start: Column) -> Column:
    """The cursor a run leaves behind: its start, to the minute."""
    return minute_start(run_start)


def request_plan(df: DataFrame, ts: str = "request_ts") -> DataFrame:
    """Request fields ``tradedt, hr, min, sec`` of each row."""
    at = F.col(ts)
    return df.withColumns(
        {
            "tradedt": datecode(at),
            "hr": two_digits(F.hour(at)),
            "min": two_digits(F.minute(at)),
            "sec": two_digits(F.second(at)),
        }
    )


def missing_days(plan: DataFrame, landed: DataFrame, day: str = "tradedt") -> DataFrame:
    """Planned requests of days without a single landed record."""
    return plan.join(landed.select(day).distinct(), day, "left_anti")
