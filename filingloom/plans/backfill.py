"""Which days a backfill still has to ask for."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from filingloom.functions.dates import timestamp
from filingloom.sources.requests import clamp_range, day_spine, missing_days, next_cursor, request_plan

# How often an empty day is asked for in a row, and the first pause, which doubles.
MAX_ATTEMPTS = 3
FIRST_DELAY_SECONDS = 2


def backfill_plan(
    ranges: DataFrame,
    landed: DataFrame | None = None,
    *,
    earliest: str | datetime,
    latest: str | datetime,
    from_col: str = "from_dt",
    to_col: str = "to_dt",
) -> DataFrame:
    """One request per day of the clamped ranges, without the days that have landed already.

    The bounds of the history are the caller's to name: ranges are brought inside them.
    """
    inside = clamp_range(ranges, from_col, to_col, earliest=earliest, latest=latest)
    days = day_spine(inside, from_col, to_col)
    plan = request_plan(days)
    return plan if landed is None else missing_days(plan, landed)


def retry_plan(
    plan: DataFrame,
    history: DataFrame,
    as_of: str | datetime,
    *,
    day: str = "tradedt",
    at: str = "asked_at",
    succeeded: Column | str = "succeeded",
    max_attempts: int = MAX_ATTEMPTS,
    first_delay: int = FIRST_DELAY_SECONDS,
) -> DataFrame:
    """What is next for each planned request, from the replies that its day has had.

    ``history`` has one row per reply: the day, when it was asked for and whether records came. Only
    replies after a day's last success count, so a day that delivered is ``done`` until it fails again.
    Then ``attempts`` replies in a row brought nothing: the next attempt is the one after them, not
    before the last reply plus a pause that doubles each time. ``state`` is ``new`` (no reply yet),
    ``due``, ``waiting`` or, after ``max_attempts``, ``given_up``; ``not_before`` is NULL unless an
    attempt is to come after a reply. Replies without a day or a time are left out, and a success at
    the time of a failure comes after it.
    """
    good = F.expr(succeeded) if isinstance(succeeded, str) else succeeded
    replies = history.select(F.col(day).alias("_day"), F.col(at).alias("_at"), F.coalesce(good, F.lit(False)).alias("_good"))
    replies = replies.where("_day is not null and _at is not null")
    # Two sums per day rather than a fold over its rows: a day may have very many replies.
    last = replies.groupBy("_day", F.xxhash64("_day").alias("_spread")).agg(
        F.max(F.when(F.col("_good"), F.col("_at"))).alias("_won"), F.max("_at").alias("_last")
    )
    after = F.col("_won").isNull() | (F.col("_at") > F.col("_won"))
    lost = replies.join(last.drop("_spread"), "_day").groupBy("_day").agg(
        F.count_if(after).alias("_attempts"), F.first("_last").alias("_last")
    )
    known = plan.join(lost, plan[day] == lost["_day"], "left")
    attempts = F.coalesce("_attempts", F.lit(0))
    pause = F.make_dt_interval(secs=first_delay * F.pow(F.lit(2), F.least(attempts, F.lit(max_attempts)) - 1))
    open_ = (attempts > 0) & (attempts < max_attempts)
    not_before = F.when(open_, F.col("_last") + pause)
    state = (
        F.when(F.col("_day").isNull(), "new")
        .when(attempts == 0, "done")
        .when(attempts >= max_attempts, "given_up")
        .when(not_before > timestamp(as_of), "waiting")
        .otherwise("due")
    )
    return known.select(
        *[plan[name] for name in plan.columns],
        attempts.cast("bigint").alias("attempts"),
        not_before.alias("not_before"),
        state.alias("state"),
    )


def cursor_log(
    runs: DataFrame,
    *,
    stream: str = "stream",
    started: str = "started_at",
    caught_up: Column | str = "caught_up",
) -> DataFrame:
    """Add to each run the cursor it started from and the one it left behind.

    The cursor moves only when a run found that nothing was new: then it is that run's start, to the
    minute. It is NULL until a run of its stream has caught up. Runs without a start are left out; of
    runs that start at the same time those that caught up come first.
    """
    good = F.expr(caught_up) if isinstance(caught_up, str) else caught_up
    moved = F.when(F.coalesce(good, F.lit(False)), next_cursor(F.col(started)))
    order = Window.partitionBy(stream).orderBy(started, moved.isNull())
    until = order.rowsBetween(Window.unboundedPreceding, 0)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return runs.where(F.col(started).isNotNull()).select(
        "*",
        F.last(moved, ignorenulls=True).over(before).alias("cursor_before"),
        F.last(moved, ignorenulls=True).over(until).alias("cursor_after"),
    )
