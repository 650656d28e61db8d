"""JSON Lines archive with an index of the ids it holds."""

from pyspark.sql import DataFrame, functions as F, types as T

from filingloom.functions.text import non_empty
from filingloom.operators.keys import keep_first, without_keys
from filingloom.sinks.tables import other_batches, write_batch
from filingloom.sinks.workspace import scratch
from filingloom.sources.stored import read_table

# The archive targets, as (data_type, fetch_type).
TARGETS = [("filter", "live"), ("filter", "hist"), ("normal", "live"), ("normal", "hist")]
# Fixed value: where every other combination goes.
FALLBACK_TARGET = ("unknown", "unknown")


def archive_jsonl(
    df: DataFrame,
    path: str,
    batch: str,
    data_type: str = "normal",
    fetch_type: str = "live",
    key: str = "news_id",
    order_by: tuple[str, ...] = ("ingest_seq",),
) -> int:
    """Add the records whose id the target does not hold; returns how many.

    The JSON lines go to ``path/records``, their ids to the Parquet index ``path/index``, so that
    finding new ids never parses archived JSON. Running a batch again replaces its own lines.
    """
    target = (data_type, fetch_type)
    data_type, fetch_type = target if target in TARGETS else FALLBACK_TARGET
    spark = df.sparkSession

    fields = [df.schema[key]] + [
        T.StructField(name, T.StringType()) for name in ("data_type", "fetch_type", "batch")
    ]
    index = read_table(spark, f"{path}/index", T.StructType(fields)).where(
        (F.col("data_type") == data_type) & (F.col("fetch_type") == fetch_type)
    )
    rows = without_keys(
        keep_first(df.where(non_empty(F.col(key))), key, order_by),
        other_batches(index, batch),
        key,
        unique=True,
    )
    # A target is a folder of its own, so a batch replaces its lines in that target alone. The new
    # records are worked out once; both writes read that copy.
    folder = f"data_type={data_type}/fetch_type={fetch_type}"
    with scratch(rows, "archive") as own:
        written = write_batch(own, f"{path}/records/{folder}", batch, (), format="json")
        write_batch(own.select(key), f"{path}/index/{folder}", batch, ())
    return written
