"""Partitioned Parquet tables, written so that a repeated write replaces what it wrote before."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from filingloom.operators.keys import keep_first, without_keys
from filingloom.sinks.workspace import delete_folder, matching_files, scratch, without_dictionaries
from filingloom.sources.stored import read_table

BATCH_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def new_rows(
    df: DataFrame, stored: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """Rows a table with a unique key takes: the first of each key that is not stored yet."""
    return without_keys(keep_first(df, keys, order_by), stored, keys, unique=True)


def even_files(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of one table partition together before the write.

    Adaptive execution merges small partitions and splits large ones to the advisory size, so a
    write makes few, even files and a partition with a third of all rows still uses many tasks.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def append_new_only(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> dict[str, int]:
    """Append the rows whose key is not stored; returns total, inserted and duplicate rows.

    Rows are written aside first and compared once more with the table as it then is, so keys that
    another writer stored in the meantime count as duplicates.
    """
    spark = df.sparkSession
    offered, taken = Observation(), Observation()

    def stored() -> DataFrame:
        return read_table(spark, path, schema or df.schema)

    rows = new_rows(df.observe(offered, F.count(F.lit(1)).alias("n")), stored(), keys, order_by)
    with scratch(rows, "aside") as aside:
        still_new = without_keys(aside, stored(), keys, narrow_first=True, unique=True)
        (
            even_files(still_new, partition_by)
            .observe(taken, F.count(F.lit(1)).alias("n"))
            .write.mode("append")
            .partitionBy(*partition_by)
            .parquet(path)
        )
    total, inserted = offered.get["n"], taken.get["n"]
    return {"total": total, "inserted": inserted, "duplicates": total - inserted}


def write_batch(
    df: DataFrame,
    path: str,
    batch: str,
    partition_by: Sequence[str],
    format: str = "parquet",
    various: Sequence[str] = (),
) -> int:
    """Write the output of one named batch; returns its rows.

    The batch name is the last partition column. Partitions that the output has are replaced by the
    write; those that only an earlier run of the same batch had are removed after it, so the table
    ends with the new output alone, also if that is empty. A run that stops in between leaves old
    partitions, which the next run removes. The overwrite mode is set for this write alone. ``various``
    names columns that are written without dictionaries.
    """
    if not BATCH_NAME.fullmatch(batch):
        raise ValueError(f"a batch is named by letters, digits, dots, dashes and underscores: {batch!r}")
    spark = df.sparkSession
    own_files = f"{path}{'/*' * len(partition_by)}/batch={batch}/part-*"
    before = matching_files(spark, own_files)
    written = Observation()
    (
        even_files(df.withColumn("batch", F.lit(batch)), partition_by)
        .observe(written, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .options(**without_dictionaries(various))
        .partitionBy(*partition_by, "batch")
        .format(format)
        .save(path)
    )
    n_written = written.get["n"]
    if before:
        after = matching_files(spark, own_files)
        for folder, files in before.items():
            if files & after.get(folder, set()):
                delete_folder(spark, folder)
    return n_written


def repeated_keys(table: DataFrame, key: str, among: Column | None = None) -> list:
    """Some of the keys that a table holds twice; none if all is well.

    With ``among``, only non-NULL keys of the rows for which that holds count.
    """
    held = F.lit(True) if among is None else F.bool_or(among) & F.col(key).isNotNull()
    counts = table.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), held.alias("_held"))
    return sorted(row[0] for row in counts.where("_n > 1 and _held").take(3))


def remove_batch(spark: SparkSession, path: str, batch: str, partition_by: Sequence[str]) -> None:
    """Take the output of one batch out of a table again."""
    for folder in matching_files(spark, f"{path}{'/*' * len(partition_by)}/batch={batch}/part-*"):
        delete_folder(spark, folder)


def other_batches(table: DataFrame, batch: str) -> DataFrame:
    """A stored table without what the named batch has written (pruned by partition)."""
    return table.where(F.col("batch") != batch)
