"""JSON array files of any size, each read by many tasks.

A file that holds one long list has no line ends to split at. It is cut at every closing brace instead,
which Spark can find in any block of the file. What a brace means depends on all that comes before it:
whether it is inside a string, and how deep. Each fragment says how it changes that state, for both
cases of beginning inside a string or not; the changes are added up inside each block, then over the
few blocks of a file, and so every fragment knows its state without anyone reading the file in order.
A record ends at a brace that leaves just the list open. Fragments of a record are joined inside their
block; the first and last piece of a block may go on in its neighbours and are stitched together.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from filingloom.sinks.workspace import broadcast_up_to, staged

BRACE = "}"
#: A fragment's place, and the block it was read from.
_BLOCK = ["file", "block"]


def _fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The text between closing braces, in order of ``row`` inside a block."""
    lines = spark.read.option("lineSep", BRACE).text(path)
    return lines.select(
        F.col("_metadata.file_modification_time").alias("arrived"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _levels(text: Column) -> Column:
    """By how many levels a text without strings goes deeper."""
    return _count(text, "{") + _count(text, "[") - _count(text, "]")


def _changes(fragments: DataFrame) -> DataFrame:
    """Add ``quotes``, and ``outside`` and ``inside``: levels gained if a fragment begins outside or inside a string.

    The brace that ends the fragment counts where it is outside a string. An escaped sign is no quote.
    """
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    quotes = _count(F.col("_plain"), '"')

    def gained(text: Column, ends_inside: Column) -> Column:
        levels = _levels(F.regexp_replace(text, r'"[^"]*("|\z)', ""))
        return (levels - F.when(ends_inside, 0).otherwise(1)).cast("long")

    odd = quotes % 2 == 1
    return (
        fragments.withColumn("_plain", plain)
        .withColumns(
            {
                "quotes": quotes.cast("long"),
                "outside": gained(F.col("_plain"), odd),
                "inside": gained(F.regexp_replace("_plain", r'^[^"]*("|\z)', ""), ~odd),
            }
        )
        .drop("_plain")
    )


def _before(blocks: DataFrame, measure: Column) -> Column:
    """A sum over the earlier blocks of a file; a file has few blocks."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(measure).over(earlier), F.lit(0))


def _with_blocks(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    return rows.join(broadcast_up_to(blocks, blocks.count()), _BLOCK)


def _pieces_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pieces of the lists: ``text`` up to and with the end of a record, numbered per file by ``piece``."""
    in_order = Window.partitionBy(*_BLOCK).orderBy("row")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    until = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # Inside a block first, as if it began outside (0) and inside (1) a string.
    begins = F.coalesce(F.sum("quotes").over(until), F.lit(0)) % 2
    counted = _changes(_fragments(spark, path)).withColumn("_begins", begins)
    own = [F.when(F.col("_begins") == case, F.col("outside")).otherwise(F.col("inside")) for case in (0, 1)]
    counted = counted.withColumns(
        {
            "_ends": (F.col("_begins") + F.col("quotes")) % 2,
            "_depth0": F.sum(own[0]).over(so_far),
            "_depth1": F.sum(own[1]).over(so_far),
        }
    )
    kept = staged(counted.drop("quotes", "outside", "inside", "_begins"), "fragments")
    # Then over the blocks: the quotes before a block choose its case, and the levels before it are added.
    sums = kept.groupBy(*_BLOCK).agg(
        F.max_by("_ends", "row").alias("_odd"), F.max_by("_depth0", "row").alias("_sum0"), F.max_by("_depth1", "row").alias("_sum1")
    )
    starts = sums.withColumn("_case", _before(sums, F.col("_odd")) % 2)
    gained = F.when(F.col("_case") == 0, F.col("_sum0")).otherwise(F.col("_sum1"))
    starts = staged(starts.withColumn("_above", _before(starts, gained)).select(*_BLOCK, "_case", "_above"), "starts")
    # A good list ends with a bracket. Where a file ends with a brace, its bytes tell.
    braces = F.sum(F.octet_length("value")) + F.count(F.lit(1)) == F.max("size")
    last = kept.groupBy("file").agg(F.max(F.struct("block", "row")).alias("_last"), braces.alias("_braced"))
    placed = _with_blocks(kept, starts).join(broadcast_up_to(last, last.count()), "file")
    depth = F.col("_above") + F.when(F.col("_case") == 0, F.col("_depth0")).otherwise(F.col("_depth1"))
    inside = (F.col("_ends") + F.col("_case")) % 2 == 1
    is_last = F.struct("block", "row") == F.col("_last")
    ends = ~inside & (depth == 1) & ~is_last
    placed = placed.select(
        "arrived", *_BLOCK, "row", "value", ends.alias("ends"), is_last.alias("is_last"), (~is_last | F.col("_braced")).alias("braced")
    )
    # Records that end in earlier blocks number the pieces of this one.
    ended = placed.groupBy(*_BLOCK).agg(F.count_if("ends").alias("_ended"))
    numbers = staged(ended.withColumn("_first", _before(ended, F.col("_ended"))), "numbers")
    numbered = _with_blocks(placed, numbers).withColumn(
        "piece", F.col("_first") + F.coalesce(F.sum(F.col("ends").cast("long")).over(until), F.lit(0))
    )
    whole = F.concat("value", F.when(F.col("braced"), BRACE).otherwise(""))
    told = F.array_sort(F.collect_list(F.struct("row", whole.alias("text"))))
    joined = numbered.groupBy(*_BLOCK, "piece").agg(
        F.min("arrived").alias("arrived"),
        F.array_join(F.transform(told, lambda f: f["text"]), "").alias("text"),
        F.bool_or("is_last").alias("final"),
        ((F.first("_first") == F.col("piece")) | (F.first(F.col("_first") + F.col("_ended")) == F.col("piece"))).alias("border"),
    )
    parts = F.array_sort(F.collect_list(F.struct("block", "text")))
    stitched = joined.where("border").groupBy("file", "piece").agg(
        F.min("arrived").alias("arrived"),
        F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"),
        F.bool_or("final").alias("final"),
    )
    columns = ["arrived", "file", "piece", "text", "final"]
    return joined.where("not border").select(*columns).unionAll(stitched.select(*columns))


def read_array_pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``listed``: each piece of a list as a list of its own; NULL where the file is no list.

    A piece begins with the list's bracket or a comma and ends with a record, or, the last one, with the
    closing bracket. So pieces of a good file are good, and a file is a list if all its pieces are.
    ``text`` is the piece as it is in the file.
    """
    text = F.regexp_replace("text", r"^[\x20\t\r\n\x{feff}]+|[\x20\t\r\n]+\z", "")
    first, final = F.col("piece") == 0, F.col("final")
    opened = F.when(first, F.col("_text").startswith("[")).otherwise(F.col("_text").startswith(",") | (final & (F.col("_text") == "]")))
    closed = ~final | F.col("_text").endswith("]")
    size = F.length("_text")
    # The bare bracket that ends a list after its last record has no comma to take away.
    bare = ~first & final & (F.col("_text") == "]")
    content = F.when(bare, "").otherwise(F.substring("_text", F.lit(2), size - 1 - final.cast("int")))
    empty = F.trim(F.translate("_content", "\t\r\n", "   ")) == ""
    allowed = ~empty | bare | (first & final)
    pieces = _pieces_of(spark, path).withColumn("_text", text)
    pieces = pieces.where(~(first & final & (F.col("_text") == "")))
    pieces = pieces.withColumn("_content", F.when(opened & closed, content))
    listed = F.when(allowed, F.concat(F.lit("["), "_content", F.lit("]")))
    return pieces.select("arrived", "file", "piece", "text", listed.alias("listed"))
