"""Mix sources to target weights: repetition rates per source, whole copies and one drawn copy.

Defined cases: a NULL text has size 0; the NULL source is a source of its own, ranked last; a document
with a NULL id draws by a digest of its text; rows that repeat an id draw alike and are each mixed on
their own; an empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from filingloom.llm.common import broadcast_if_small, word_count
from filingloom.sinks.workspace import checkpointed

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"


def source_targets(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """Size, target and rate of every source: (source, source_size, target, rate), one row each.

    Sources in code point order, NULL last, take ``weights`` in turn and share ``share`` times all
    sizes. No target exceeds ``most`` times its source's size; what is over is shared by weight among
    the others until none is above. That is one common level: with sources in order of room per weight
    the level is what is left after filling the first ones, over the weights still open.
    """
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    # One row per source from here on, so the windows below hold as many rows as there are sources.
    totals = checkpointed(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    ranked = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1)).withColumn(
        "room", F.col("source_size") * F.lit(float(most))
    )
    by_room = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("room").over(before), F.lit(0.0))
    ) / F.sum("weight").over(after)
    levels = ranked.withColumn("level", level).withColumn("place", F.row_number().over(by_room))
    open_place = F.when(F.col("level") <= F.col("room") / F.col("weight"), F.col("place"))
    common = F.min_by("level", open_place).over(everything)
    target = F.least(F.col("weight") * F.coalesce(common, F.lit(float("inf"))), F.col("room"))
    return levels.withColumn("target", target).select(
        "source",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def draw(seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the document alone."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5("text")), F.lit("none"))
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**13))


def with_copies(docs: DataFrame, seed: str = SEED, **targets) -> DataFrame:
    """Every document with ``size``, ``source_size``, ``target``, ``rate`` and its number of ``copies``.

    ``copies`` is the whole part of the rate, and one more if the document's draw is below the rest.
    Documents meet their source's row in a join that is broadcast while the sources are few.
    """
    own = ["size", "source_size", "target", "rate", "copies"]
    sources = source_targets(docs, **targets)
    sources = broadcast_if_small(sources, "source").withColumnRenamed("source", "_source")
    kept = docs.drop(*own)
    joined = kept.withColumn("size", word_count(F.col("text"))).join(
        sources, F.col("source").eqNullSafe(F.col("_source"))
    )
    whole = F.floor("rate")
    extra = F.when(draw(seed) < F.col("rate") - whole, 1).otherwise(0)
    return joined.withColumn("copies", (whole + extra).cast("long")).select(*kept.columns, *own)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it has copies, numbered from 1 in ``copy``.

    The rows keep the columns of ``docs``; an input column ``copy`` is replaced.
    """
    counted = with_copies(docs, **options).filter(F.col("copies") > 0)
    kept = [c for c in docs.columns if c != "copy"]
    return counted.select(*kept, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
