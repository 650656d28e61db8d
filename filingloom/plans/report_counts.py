"""Counts per base report id, kept beside the reports and brought up to date folder by folder.

Each folder of the reports table (quarter, type, batch) has its own counts, stored under a mark of the
folder's files. A folder that a batch, a rerun, a removal or a compaction has written anew has other files,
so its counts are recognised as old and made again from that folder alone; counts of folders that are gone
are removed. What is looked up is the sum over folders: rows per base id and folder, however many reports.
"""

import hashlib
from collections.abc import Iterable
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from filingloom.functions.text import non_empty, without_last_part
from filingloom.schemas import REPORTS
from filingloom.sinks.workspace import broadcast_up_to, delete_folder, matching_files
from filingloom.sources.stored import empty_table

PARTITIONS = ("quarter_start", "report_type", "batch")
COUNTS = T.StructType(
    [
        T.StructField("base_report_id", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("highest", T.LongType()),
    ]
)


def _marks(spark: SparkSession, path: str, quarters: Iterable[date] | None) -> dict[tuple[str, ...], tuple[str, str]]:
    """By (quarter, type, batch), as in the folder names: the folder and a mark of its files."""
    names = ["*"] if quarters is None else sorted({day.isoformat() for day in quarters})
    found = {}
    for name in names:
        for folder, files in matching_files(spark, f"{path}/quarter_start={name}/*/*/part-*").items():
            mark = hashlib.md5("\n".join(sorted(files)).encode()).hexdigest()
            found[tuple(folder.split("/")[-3:])] = (folder, mark)
    return found


def _counted(spark: SparkSession, path: str, quarters: Iterable[date] | None) -> dict[tuple[str, ...], dict[str, str]]:
    """By (quarter, type, batch): the folders of stored counts by their mark."""
    names = ["*"] if quarters is None else sorted({day.isoformat() for day in quarters})
    found: dict[tuple[str, ...], dict[str, str]] = {}
    for name in names:
        for folder in matching_files(spark, f"{path}/quarter_start={name}/*/*/*/part-*"):
            *key, mark = folder.split("/")[-4:]
            found.setdefault(tuple(key), {})[mark.removeprefix("files=")] = folder
    return found


def _folder_counts(reports: DataFrame) -> DataFrame:
    """Distinct report ids and the highest number per folder and base id."""
    last = F.regexp_extract("report_id", "([0-9]{1,18})$", 1).try_cast("bigint")
    ids = reports.where(non_empty(F.col("report_id"))).select(
        *PARTITIONS, "report_id", without_last_part(F.col("report_id")).alias("base_report_id"), last.alias("_number")
    )
    return ids.distinct().groupBy(*PARTITIONS, "base_report_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("_number").alias("highest")
    )


def refresh_counts(
    spark: SparkSession, reports_path: str, counts_path: str, quarters: Iterable[date] | None = None
) -> list[str]:
    """Bring stored counts in line with the reports; returns the folders of counts that hold.

    Counts of a folder are complete once they are there: a run that stops in between leaves folders
    without counts, or old counts beside new ones, and the next run finishes. One writer at a time.
    """
    reports = _marks(spark, reports_path, quarters)
    counted = _counted(spark, counts_path, quarters)
    stale = {key: own for key, own in reports.items() if own[1] not in counted.get(key, {})}
    if stale:
        named = [
            (*(unquote(part.split("=", 1)[1]) for part in key), mark) for key, (_, mark) in stale.items()
        ]
        marks = spark.createDataFrame(named, "_quarter string, _type string, _batch string, files string")
        folders = [folder for folder, _ in stale.values()]
        rows = spark.read.schema(REPORTS).option("basePath", reports_path).parquet(*folders)
        same = (
            (F.col("quarter_start").cast("string") == F.col("_quarter"))
            & (F.col("report_type") == F.col("_type"))
            & (F.col("batch") == F.col("_batch"))
        )
        fresh = _folder_counts(rows).join(broadcast_up_to(marks, len(named)), same)
        (
            fresh.select("base_report_id", "n", "highest", *PARTITIONS, "files")
            .hint("rebalance", *PARTITIONS)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITIONS, "files")
            .parquet(counts_path)
        )
        counted = _counted(spark, counts_path, quarters)
    valid = []
    for key, folders in counted.items():
        for mark, folder in folders.items():
            if key in reports and reports[key][1] == mark:
                valid.append(folder)
            else:
                delete_folder(spark, folder)
    return sorted(valid)


def report_counts(
    spark: SparkSession, reports_path: str, counts_path: str, quarters: Iterable[date] | None = None
) -> DataFrame:
    """``taken_numbers`` of a stored reports table (``base_report_id, n``) from maintained counts.

    Report ids are unique over the folders of the table, as the store sees to when it publishes.
    """
    folders = refresh_counts(spark, reports_path, counts_path, quarters)
    rows = spark.read.schema(COUNTS).parquet(*folders) if folders else empty_table(spark, COUNTS)
    total = rows.groupBy("base_report_id").agg(F.sum("n").alias("n"), F.max("highest").alias("highest"))
    return total.select("base_report_id", F.greatest("n", F.coalesce("highest", F.lit(0))).alias("n"))
