"""Working storage for intermediate results that must outlive executors."""

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# Up to this many ids are sent to every executor.
MAX_BROADCAST_ROWS = 100_000


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where one process is the whole cluster may it be unset: a temporary folder is taken then.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not context.getCheckpointDir():
        one_process = re.fullmatch(r"local(\[[^\]]*\])?", context.master)
        if not configured and not one_process:
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="filingloom-"))
    return configured or context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing uses yet."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def broadcast_up_to(df: DataFrame, n_rows: int) -> DataFrame:
    """Mark a counted, narrow table for broadcast while it is short; else leave the join to Spark."""
    return F.broadcast(df) if n_rows <= MAX_BROADCAST_ROWS else df


def hadoop_path(spark: SparkSession, uri: str):
    """A file system path and the file system it is on."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, uri: str) -> bool:
    path, system = hadoop_path(spark, uri)
    return system.exists(path)


def delete_folder(spark: SparkSession, uri: str) -> None:
    path, system = hadoop_path(spark, uri)
    system.delete(path, True)


def child_folders(spark: SparkSession, uri: str) -> list[str]:
    """Names of the folders right below one; one listing call."""
    path, system = hadoop_path(spark, uri)
    if not system.exists(path):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(path) if s.isDirectory())


def matching_files(spark: SparkSession, pattern: str) -> dict[str, set[str]]:
    """Files that a path pattern names: the file names by folder."""
    path, system = hadoop_path(spark, pattern)
    found: dict[str, set[str]] = {}
    for status in system.globStatus(path) or []:
        own = status.getPath()
        found.setdefault(str(own.getParent()), set()).add(own.getName())
    return found


def without_dictionaries(columns: Sequence[str]) -> dict[str, str]:
    """Options of a Parquet write: no dictionary is tried for columns whose values hardly ever repeat."""
    return {f"parquet.enable.dictionary#{name}": "false" for name in columns}


def staged(
    df: DataFrame,
    name: str,
    path: str | None = None,
    various: Sequence[str] = (),
    spark: SparkSession | None = None,
) -> DataFrame:
    """Write once as Parquet in the shared folder and read back.

    For a result that several later steps read: each step then scans just the columns it needs
    instead of computing the result again. ``various`` names columns that are written without
    dictionaries. ``spark`` is the session that reads, if not the one that writes.
    """
    path = path or new_folder(df.sparkSession, name)
    df.write.options(**without_dictionaries(various)).parquet(path)
    return (spark or df.sparkSession).read.schema(df.schema).parquet(path)


@contextmanager
def scratch(
    df: DataFrame, name: str, various: Sequence[str] = (), spark: SparkSession | None = None
) -> Iterator[DataFrame]:
    """``staged`` for the length of a ``with`` block; the copy is removed when the block is left."""
    path = new_folder(df.sparkSession, name)
    try:
        yield staged(df, name, path, various, spark)
    finally:
        delete_folder(df.sparkSession, path)
