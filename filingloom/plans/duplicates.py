"""Remove duplicate rows from a stored table in place."""

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from filingloom.operators.keys import surplus_rows
from filingloom.sinks.tables import even_files
from filingloom.sinks.workspace import broadcast_up_to, delete_folder, path_exists, staged
from filingloom.sources.stored import read_table


def remove_duplicates(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    ids: DataFrame | None = None,
    key: str = "news_id",
    order_by: Sequence[str] = ("document_date", "count", "report_id"),
) -> int:
    """Keep the first row of each key (of the listed ``ids``, if given); returns the rows removed.

    Only partition folders that hold surplus rows are rewritten; those left without a row are dropped
    last. What stays of them is written next to the table first, and that copy is removed only when
    the table is complete: a run that fails in between is finished by the next one, from the copy.
    One writer at a time.
    """
    work = f"{path.rstrip('/')}__duplicates"
    if not path_exists(spark, f"{work}/ready/_SUCCESS"):
        if not _prepare(spark, path, schema, ids, key, order_by, work):
            delete_folder(spark, work)
            return 0
    return _publish(spark, path, schema, list(partition_by), work)


def _prepare(spark, path, schema, ids, key, order_by, work) -> bool:
    """Write the surplus rows' places and what stays of their folders; False if there are none."""
    rows = read_table(spark, path, schema)
    if rows.isEmpty():
        return False
    delete_folder(spark, work)
    file = F.col("_metadata.file_path")
    located = rows.withColumns(
        {"_file": file, "_index": F.col("_metadata.row_index"), "_folder": F.regexp_replace(file, "/[^/]*$", "")}
    )
    # Narrow rows are ranked: the key, what orders its rows, and the place.
    place = F.struct(*order_by, "_file", "_index").alias("_row")
    surplus = staged(
        surplus_rows(located.select(key, place, "_folder"), ids, key, "_row").select(
            "_folder", F.col("_row._file").alias("_file"), F.col("_row._index").alias("_index")
        ),
        "surplus",
        f"{work}/surplus",
    )
    affected = surplus.select("_folder").distinct()
    n_affected = affected.count()
    if not n_affected:
        return False
    affected = broadcast_up_to(affected, n_affected)
    staged(
        located.join(affected, "_folder", "left_semi").join(surplus, ["_file", "_index"], "left_anti"),
        "kept",
        f"{work}/kept",
    )
    spark.range(1).write.mode("overwrite").parquet(f"{work}/ready")
    return True


def _publish(spark, path, schema, partition_by, work) -> int:
    """Put what stays in place of the folders it comes from. Doing it twice gives the same table."""
    surplus = spark.read.parquet(f"{work}/surplus")
    kept = spark.read.parquet(f"{work}/kept")
    (
        even_files(kept.select(*schema.fieldNames()), partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    removed = surplus.count()
    emptied = surplus.select("_folder").subtract(kept.select("_folder").distinct())
    for (folder,) in emptied.toLocalIterator():  # at most one per partition of the table
        if partition_by:
            delete_folder(spark, unquote(folder))
    delete_folder(spark, work)
    return removed
