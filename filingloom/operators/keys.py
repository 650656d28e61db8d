"""Operators on keys: keep, exclude, first row per key, duplicates.

No operator here gathers the rows of one key in one place. The first row of a key is chosen by a
ranking window that Spark limits to one row per key and task before the shuffle; counts and minima
are pre-aggregated. Joins have at most one row per key on the right: Spark broadcasts it while it is
small, and otherwise adaptive execution splits the left partition of a key with very many rows. It
can do so only where both sides are shuffled for the join alone, so the right side is grouped by the
key and its hash: that layout serves no join, and the join adds a shuffle of the few keys.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from filingloom.functions.text import non_empty


def _columns(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _in_order(df: DataFrame, joined: DataFrame) -> DataFrame:
    """The columns in their own order; a join by name puts the key in front."""
    return joined.select(*[f"`{name}`" for name in df.columns])


def keep_first(
    df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """First row of each key in the given order."""
    window = Window.partitionBy(*_columns(keys)).orderBy(*order_by)
    return (
        df.withColumn("_position", F.row_number().over(window))
        .where("_position = 1")
        .drop("_position")
    )


def first_of_each_text(df: DataFrame, text: str, order_by: Sequence[str | Column]) -> DataFrame:
    """First row of each whole text, without the text: a 256-bit digest of it is moved and compared."""
    digest = F.sha2(F.col(text), 256).alias("_digest")
    return keep_first(df.select("*", digest).drop(text), "_digest", order_by).drop("_digest")


def keep_last(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last row of each key in the given order."""
    return keep_first(df, keys, [F.col(name).desc() for name in order_by])


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-empty values of one text key."""
    return df.select(key).where(non_empty(F.col(key))).distinct()


def _per_key(df: DataFrame, on: list[str], *measures: Column) -> DataFrame:
    """One row per key, laid out so that a join on the key can be split."""
    spread = F.xxhash64(*on).alias("_spread")
    if not measures:
        return df.select(*on, spread).distinct().drop("_spread")
    return df.groupBy(*on, spread).agg(*measures).drop("_spread")


def only_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in ``keys``."""
    on = _columns(on)
    return _in_order(df, df.join(_per_key(keys, on), on, "left_semi"))


def without_keys(
    df: DataFrame,
    keys: DataFrame,
    on: str | Sequence[str],
    narrow_first: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Rows whose key is not in ``keys``. Rows with a NULL key stay.

    ``unique`` says that ``df`` has one row per key: then nothing needs splitting and the join shares
    the shuffle ``df`` comes from.

    ``narrow_first`` suits a small ``df`` that is cheap to read twice against a big ``keys``: the
    keys are first cut down to those that occur in ``df``, so that Spark can keep the big side in
    place and move only ``df``'s keys.
    """
    on = _columns(on)
    known = keys.select(*on)
    if narrow_first:
        own = df.select(*on) if unique else _per_key(df, on)
        known = known.join(own, on, "left_semi")
    known = known.distinct() if unique else _per_key(known, on)
    return _in_order(df, df.join(known, on, "left_anti"))


def ids_difference(ids: DataFrame, minus: DataFrame, on: str) -> DataFrame:
    """Distinct ids that are not in ``minus``."""
    return ids.select(on).subtract(minus.select(on))


def duplicate_groups(df: DataFrame, key: str = "news_id", row_id: str = "row_id") -> DataFrame:
    """Keys held by more than one row, with the number of rows and the row to keep."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min(row_id).alias("keep_id"))
        .where("n_rows > 1")
    )


def _among(df: DataFrame, ids: DataFrame | None, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()) if ids is None else only_keys(df, ids, key)


def surplus_rows(
    df: DataFrame, ids: DataFrame | None = None, key: str = "news_id", row_id: str = "row_id"
) -> DataFrame:
    """Every row but the first of each key; with ``ids``, only for the keys listed there.

    Only keys that do have copies are joined back, which leaves a small right side where copies are
    few or belong to few keys.
    """
    listed = _among(df, ids, key)
    copies = F.count(F.lit(1)).alias("_copies")
    groups = _per_key(listed, [key], copies, F.min(row_id).alias("keep_id")).where("_copies > 1")
    surplus = listed.join(groups, key).where(F.col(row_id) > F.col("keep_id"))
    return _in_order(df, surplus)


def without_surplus(
    df: DataFrame, ids: DataFrame | None = None, key: str = "news_id", row_id: str = "row_id"
) -> DataFrame:
    """All rows but those of ``surplus_rows``. Rows with a NULL key stay."""
    surplus = surplus_rows(df, ids, key, row_id).select(row_id)
    return _in_order(df, df.join(surplus, row_id, "left_anti"))
