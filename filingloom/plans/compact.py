"""Merge the folders of many batches into one."""

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession, functions as F, types as T

from filingloom.plans.ingest import Store
from filingloom.schemas import REPORTS
from filingloom.sinks.tables import BATCH_NAME, even_files
from filingloom.sinks.workspace import delete_folder, hadoop_path, matching_files, path_exists
from filingloom.sources.stored import read_table


def compact(spark: SparkSession, store: Store, into: str, batches: Iterable[str]) -> dict[str, int]:
    """Give the rows of some batches to one batch ``into``; returns the files of each table after it.

    For batches that are done for good: a batch that runs again afterwards finds its rows stored
    under the new name and writes none. Rows, ids and numbers stay as they are. The merged copy is
    complete beside the table before anything is removed, and a run that fails is finished by the
    next one from that copy. Do not read or write the store meanwhile.
    """
    names = sorted(set(batches))
    if not BATCH_NAME.fullmatch(into) or into in names:
        raise ValueError(f"merge into a new batch with a plain name, not {into!r}")
    return {
        "announcements": _merge(
            spark, store.announcements_path, store.announcements_schema,
            Store.ANNOUNCEMENT_PARTITIONS, into, names,
        ),
        "reports": _merge(
            spark, store.reports_path, REPORTS, Store.REPORT_PARTITIONS, into, names
        ),
    }


def _merge(
    spark: SparkSession, path: str, schema: T.StructType, parts: Sequence[str], into: str, names: list[str]
) -> int:
    copy = f"{path}__merged_{into}"
    if path_exists(spark, path) and not path_exists(spark, f"{copy}/_SUCCESS"):
        delete_folder(spark, copy)
        rows = read_table(spark, path, schema).where(F.col("batch").isin(names))
        merged = even_files(rows.withColumn("batch", F.lit(into)), parts)
        merged.write.partitionBy(*parts, "batch").parquet(copy)
    depth = "/*" * len(parts)
    if path_exists(spark, copy):
        for name in names:
            for folder in matching_files(spark, f"{path}{depth}/batch={name}/*"):
                delete_folder(spark, folder)
        for folder in matching_files(spark, f"{copy}{depth}/batch={into}/part-*"):
            inside = re.sub(rf"^.*{re.escape(copy.rstrip('/').rsplit('/', 1)[-1])}/", "", folder)
            target, system = hadoop_path(spark, f"{path}/{inside}")
            system.mkdirs(target.getParent())
            if not system.rename(hadoop_path(spark, folder)[0], target):
                raise OSError(f"cannot move {folder} to {target}")
        delete_folder(spark, copy)
    return sum(map(len, matching_files(spark, f"{path}{depth}/batch={into}/part-*").values()))
