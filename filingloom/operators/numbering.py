"""Running numbers inside groups."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from filingloom.sinks.workspace import broadcast_up_to, checkpointed

# A group of this many rows sorts well inside one task, whole texts included.
MAX_GROUP_ROWS = 500_000


def number_within(
    df: DataFrame,
    group: str,
    order_by: Sequence[str],
    start: DataFrame | None = None,
    into: str = "count",
    max_group_rows: int = MAX_GROUP_ROWS,
    rows_at_most: int | None = None,
    given: str | None = None,
) -> DataFrame:
    """Number the rows of each group 1, 2, 3, ... in the given order, as a BIGINT.

    ``start`` holds, per group, how many numbers are taken already (columns ``group`` and ``n``);
    groups it does not mention start at 1. ``order_by`` must be a total order inside a group. Rows
    without a group are left out. ``given`` names a column of numbers: a row that has one keeps it, and
    the others are numbered as if it were not there.

    Group sizes are counted first: a narrow, pre-aggregated pass, left out when the caller knows that
    there are ``rows_at_most`` so many rows and one group could hold them all. Groups of ordinary size
    are numbered by a window. Groups above ``max_group_rows`` are spread over many tasks by range, see
    ``_number_spread``. They are as many tasks as the session's shuffles have, or as it takes to keep each
    below ``MAX_GROUP_ROWS``; a small ``max_group_rows`` adds none, for every task reports to the driver.
    All ways give the same numbers.
    """
    df = df.where(F.col(group).isNotNull())
    if rows_at_most is not None and rows_at_most <= max_group_rows:
        return _number_by_window(df, group, order_by, start, into, given)
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    oversized = sizes.where(F.col("_size") > max_group_rows)
    n_groups, n_rows = oversized.agg(F.count(F.lit(1)), F.sum("_size")).first()
    if not n_groups:
        return _number_by_window(df, group, order_by, start, into, given)

    # From here on the rows are read twice: they are worked out once more and kept.
    df = checkpointed(df)
    large = checkpointed(oversized.select(group))
    large = broadcast_up_to(large, n_groups)
    parts = _parts(df.sparkSession, n_rows, max_group_rows)
    ordinary = _number_by_window(
        df.join(large, group, "left_anti"), group, order_by, start, into, given
    )
    crowded = df.join(large, group, "left_semi")
    if given is None:
        return ordinary.unionByName(_number_spread(crowded, group, order_by, start, into, parts))
    spread = _number_spread(crowded.where(F.col(given).isNull()), group, order_by, start, into, parts)
    kept = crowded.where(F.col(given).isNotNull()).withColumn(into, F.col(given).cast("bigint"))
    return ordinary.unionByName(spread).unionByName(kept)


def _parts(spark: SparkSession, n_rows: int, max_group_rows: int) -> int:
    """How many tasks share the rows of the large groups."""
    needed = 2 * -(-n_rows // MAX_GROUP_ROWS)
    ordinary = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(2 * -(-n_rows // max_group_rows), max(needed, ordinary))


def _with_start(df: DataFrame, start: DataFrame | None, group: str) -> DataFrame:
    if start is None:
        return df.withColumn("_start", F.lit(0).cast("bigint"))
    taken = start.select(group, F.col("n").alias("_start"))
    return df.join(taken, group, "left").withColumn("_start", F.coalesce("_start", F.lit(0)))


def _number_by_window(df, group, order_by, start, into, given=None) -> DataFrame:
    """Window and join share one shuffle on the group and, as the window comes first, one sort of the rows."""
    window = Window.partitionBy(group).orderBy(*order_by)
    if given is None:
        position = F.row_number().over(window)
    else:
        so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        position = F.count_if(F.col(given).isNull()).over(so_far)
    placed = df.withColumn("_position", position.cast("bigint"))
    number = F.col("_start") + F.col("_position")
    if given is not None:
        number = F.coalesce(F.col(given).cast("bigint"), number)
    return _with_start(placed, start, group).withColumn(into, number).drop("_start", "_position")


def _number_spread(df, group, order_by, start, into, parts: int) -> DataFrame:
    """Number groups too large for one task.

    Rows are range-partitioned by group and order and sorted there, so each part holds a contiguous
    run of a group, and row ids grow by one along it. A row's number is the rows of its group in
    earlier parts plus its place in the run, which is its id less the first id of the run. The range
    bounds are sampled, so placement and ids are fixed by a checkpoint; rows do not move again, for
    the runs are no more than the parts and groups together.
    """
    placed = checkpointed(
        df.repartitionByRange(parts, group, *order_by)
        .sortWithinPartitions(group, *order_by)
        .withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    )
    runs = placed.groupBy(group, "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first")
    )
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    run_start = (
        _with_start(runs, start, group)
        .withColumn("_before", F.col("_start") + F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .select(group, "_part", "_before", "_first")
    )
    run_start = checkpointed(run_start)
    run_start = broadcast_up_to(run_start, run_start.count())
    return (
        placed.join(run_start, [group, "_part"])
        .withColumn(into, F.col("_before") + F.col("_row") - F.col("_first") + F.lit(1))
        .drop("_part", "_before", "_first", "_row")
        .select(*df.columns, into)
    )
