"""Landed announcements and landed HTTP replies.

Three layouts of announcements are read: ``lines`` (one JSON object per line, which Spark splits
freely), ``array`` (one JSON array per file, as a single reply is; such a file is one task) and
``big_array`` (the same, but a file is read by many tasks; not for streams). Schemas are explicit and
nothing is inferred. Nothing is lost unseen: what is no record is listed by ``read_rejects`` and
``rejected_records``, and a record keeps its whole JSON text in ``record``, with the fields no schema
names.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from filingloom.schemas import RAW_ANNOUNCEMENT
from filingloom.sinks.workspace import staged
from filingloom.sources.arrays import read_array_pieces

# Fixed value: what a reply says when a day has no announcements.
NO_RECORD_MESSAGE = "No Record found"


# Ends the list that a text is parsed in; no text can know it.
_END = uuid.uuid4().hex

# JSON as the standard has it.
_JSON = {"allowSingleQuotes": "false"}


def _parsed(text: Column) -> Column:
    """A text as the first element of a list that ends with ``_END``; NULL if that is no JSON.

    Parsers stop after the first value. If the list's own end is the second element and no third one
    follows, the text was one value from its first to its last sign: see :func:`_strict`.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))


def _strict(parsed: Column) -> Column:
    ends = F.try_variant_get(parsed, "$[1]", "string") == _END
    return F.coalesce(ends, F.lit(False)) & F.try_variant_get(parsed, "$[2]", "variant").isNull()


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used, in filters as well."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strict_json(text: Column) -> Column:
    """Whether a text is JSON from its first to its last sign."""
    return _once(_parsed(text), _strict)


def _elements(text: Column) -> Column:
    """The elements of a JSON list; NULL if the text is none."""
    return _once(_parsed(text), lambda v: F.when(_strict(v), F.try_variant_get(v, "$[0]", "array<variant>")))


def _value(text: Column) -> Column:
    """The value of a JSON text; NULL if it is none."""
    return _once(_parsed(text), lambda v: F.when(_strict(v), F.try_variant_get(v, "$[0]", "variant")))


def _is_object(element: Column) -> Column:
    return F.coalesce(F.schema_of_variant(element).startswith("OBJECT"), F.lit(False))


def _with_file(df: DataFrame) -> DataFrame:
    """Add ``ingest_file``: when the file arrived, which it is, and where its block starts."""
    return df.withColumn(
        "ingest_file",
        F.struct(
            F.col("_metadata.file_modification_time").alias("arrived"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        ),
    )


def with_arrival_order(df: DataFrame) -> DataFrame:
    """Replace ``ingest_file`` by ``ingest_seq``, which sorts rows as they arrived.

    Inside a block the row id grows with the position in the file, whichever task reads it. Use it
    on rows as they come from the files, before any shuffle.
    """
    order = F.struct("ingest_file.*", F.monotonically_increasing_id().alias("row"))
    return df.withColumn("ingest_seq", order).drop("ingest_file")


def _pieces(files: DataFrame, layout: str) -> DataFrame:
    """``record``, the text of each landed record or of what should have been one, and ``good``."""
    text = F.col("value")
    rows = _with_file(files).where(text.rlike(r"\S"))
    if layout == "lines":
        good = strict_json(text) & text.rlike(r"^\s*\{")
        return rows.select("ingest_file", text.alias("record"), good.alias("good"))
    whole = _once(_value(text), lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v)))
    each = rows.select("ingest_file", "value", F.explode(whole).alias("_element"))
    return each.select(
        "ingest_file",
        F.coalesce(F.to_json("_element"), text).alias("record"),
        _is_object(F.col("_element")).alias("good"),
    )


def _elements_of_pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Elements of big arrays: ``record``, ``good`` and ``ingest_seq``. A file that is no list has no good one."""
    # Each piece is parsed once: what it holds is kept beside it, and NULL tells that it is no list.
    element = F.transform(
        _elements(F.col("listed")), lambda e: F.struct(F.to_json(e).alias("record"), _is_object(e).alias("good"))
    )
    pieces = read_array_pieces(spark, path).select("arrived", "file", "piece", "text", element.alias("elements"))
    pieces = staged(pieces, "pieces")
    broken = pieces.where("elements is null").select("file").distinct()
    sound = pieces.join(broken, "file", "left_anti")
    each = sound.select("arrived", "file", "piece", F.posexplode("elements").alias("row", "_element"))
    order = F.struct("arrived", "file", F.col("piece").alias("block"), F.col("row").cast("bigint").alias("row"))
    elements = each.select(order.alias("ingest_seq"), "_element.record", "_element.good")
    lost = pieces.join(broken, "file", "left_semi").withColumn("row", F.lit(0))
    return elements.unionByName(lost.select(order.alias("ingest_seq"), F.col("text").alias("record"), F.lit(False).alias("good")))


def _read(reader, path: str | list[str], layout: str) -> DataFrame:
    if layout not in ("lines", "array"):
        raise ValueError(f"layout must be lines, array or, in a batch, big_array, not {layout!r}")
    return _pieces(reader.option("wholetext", layout == "array").text(path), layout)


def _typed(pieces: DataFrame, extra: T.StructType | None) -> DataFrame:
    schema = T.StructType(RAW_ANNOUNCEMENT.fields + (extra.fields if extra else []))
    parsed = pieces.where("good").withColumn("_typed", F.from_json("record", schema, _JSON))
    order = "ingest_seq" if "ingest_seq" in pieces.columns else "ingest_file"
    return parsed.select("_typed.*", "record", order)


def read_announcements(
    spark: SparkSession,
    path: str | list[str],
    layout: str = "lines",
    extra: T.StructType | None = None,
) -> DataFrame:
    """Raw announcements with ``record`` and ``ingest_seq``; fields named in ``extra`` get columns."""
    if layout == "big_array":
        return _typed(_elements_of_pieces(spark, path), extra)
    return with_arrival_order(_typed(_read(spark.read, path, layout), extra))


def read_rejects(spark: SparkSession, path: str | list[str], layout: str = "lines") -> DataFrame:
    """What landed and is no record: ``file`` and ``record``, its text.

    A line that is no JSON object, an element of a list that is none, or a whole file whose JSON is
    broken (its pieces, for a big array). Together with ``read_announcements`` these are all landed records.
    """
    if layout == "big_array":
        lost = _elements_of_pieces(spark, path).where(~F.col("good"))
        return lost.select(F.col("ingest_seq.file").alias("file"), "record")
    pieces = _read(spark.read, path, layout).where(~F.col("good"))
    return pieces.select(F.col("ingest_file.file").alias("file"), "record")


def stream_announcements(
    spark: SparkSession,
    path: str,
    layout: str = "lines",
    extra: T.StructType | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same as a stream of files, oldest first, with ``ingest_file``."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _typed(_read(reader, path, layout), extra)


def triage(responses: DataFrame, status: str = "status", body: str = "body") -> DataFrame:
    """Add ``status_class`` to landed replies.

    ``ok`` (a list), ``no_record``, ``http_error``, ``unparseable``, ``unexpected_object`` or
    ``unexpected_type``. Only ``ok`` replies hold records. A body must be JSON to its last sign;
    numbers that JSON does not know, such as NaN, make it unparseable.
    """

    def of(parsed: Column) -> Column:
        found = F.try_variant_get(parsed, "$[0]", "variant")
        return _once(
            F.struct(
                F.when(_strict(parsed), F.schema_of_variant(found)).alias("kind"),
                F.try_variant_get(found, "$.Error_Msg", "string").alias("message"),
            ),
            lambda v: F.when(v["kind"].isNull(), "unparseable")
            .when(v["kind"].startswith("ARRAY"), "ok")
            .when(v["message"] == NO_RECORD_MESSAGE, "no_record")
            .when(v["kind"].startswith("OBJECT"), "unexpected_object")
            .otherwise("unexpected_type"),
        )

    failed = F.coalesce(F.col(status) != 200, F.lit(True))
    return responses.withColumn("status_class", F.when(failed, "http_error").otherwise(_once(_parsed(F.col(body)), of)))


def _exploded(triaged: DataFrame, body: str) -> tuple[list[str], DataFrame]:
    others = [name for name in triaged.columns if name not in (body, "status_class")]
    elements = F.posexplode(_elements(F.col(body))).alias("position", "_element")
    rows = triaged.where("status_class = 'ok'").select(*others, elements)
    return others, rows.withColumn("position", F.col("position").cast("bigint"))


def records(
    triaged: DataFrame, schema: T.StructType = RAW_ANNOUNCEMENT, body: str = "body"
) -> DataFrame:
    """One row per record of the ``ok`` replies, with its ``position`` in the reply.

    Elements that are no objects are left to ``rejected_records``.
    """
    others, rows = _exploded(triaged, body)
    parsed = F.from_json(F.to_json("_element"), schema, _JSON).alias("_record")
    good = rows.where(_is_object(F.col("_element"))).select(*others, "position", parsed)
    return good.select(*others, "position", "_record.*")


def rejected_records(triaged: DataFrame, body: str = "body") -> DataFrame:
    """What the replies hold that is no record, with ``position`` (NULL: the whole body), reason, text."""
    others, rows = _exploded(triaged, body)
    elements = rows.where(~_is_object(F.col("_element"))).select(
        *others, "position", F.lit("no_object").alias("reason"), F.to_json("_element").alias("text")
    )
    bodies = triaged.where("status_class not in ('ok', 'no_record', 'http_error')").select(
        *others,
        F.lit(None).cast("bigint").alias("position"),
        F.col("status_class").alias("reason"),
        F.col(body).alias("text"),
    )
    return elements.unionByName(bodies)


def record_count(body: Column) -> Column:
    """Elements of a reply; 0 unless it is a list."""
    return F.coalesce(F.size(_elements(body)), F.lit(0)).cast("bigint")
