"""Stream-side duplicate removal under a watermark."""

from pyspark.sql import DataFrame, functions as F


def dedup_within_watermark(
    stream: DataFrame,
    key: str = "news_id",
    event_time: str = "dt",
    delay: str = "5 days",
    spread: int = 16,
) -> DataFrame:
    """One row per key among rows at most ``delay`` apart; older rows than that are late.

    Suits sinks that only need some row of a key: which copy survives is the first one to arrive.
    Copies are first thinned out per slot of input partitions, so a key with very many copies is
    worked on by ``spread`` tasks before its survivors meet. A slot stays the same when a task is
    run again.
    """
    slot = F.pmod(F.spark_partition_id(), F.lit(spread))
    return (
        stream.withColumn("_slot", slot)
        .withWatermark(event_time, delay)
        .dropDuplicatesWithinWatermark([key, "_slot"])
        .dropDuplicatesWithinWatermark([key])
        .drop("_slot")
    )
