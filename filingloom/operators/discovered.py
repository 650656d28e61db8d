"""Columns for the fields of JSON records that no schema names.

One pass over the records finds which fields they have and of what type: Spark merges the schemas of
all records while it aggregates, so only field names and types reach the driver. The fields are then
read from the parsed record as columns with dotted names.
"""

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: More fields than this are no fields but data, such as ids used as names.
MAX_FIELDS = 2000
_MARK = re.compile(r"`(?:[^`]|``)*`|OBJECT<")


@dataclass(frozen=True)
class Field:
    """A field of a record: where it is and its type; a type of None is any JSON."""

    path: tuple[str, ...]
    dtype: T.DataType | None

    @property
    def name(self) -> str:
        return ".".join(self.path)


def _has_variant(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_variant(dtype.elementType)
    return isinstance(dtype, (T.VariantType, T.StructType, T.NullType))


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[Field]:
    found = []
    for field in schema.fields:
        here, dtype = (*path, field.name), field.dataType
        if isinstance(dtype, T.StructType):
            found += _leaves(dtype, here)
        elif isinstance(dtype, T.NullType):
            found.append(Field(here, T.StringType()))
        else:
            found.append(Field(here, None if _has_variant(dtype) else dtype))
    return found


def discover_fields(df: DataFrame, record: str = "record", max_fields: int = MAX_FIELDS) -> list[Field]:
    """The fields of the JSON objects in a text column, in order of their paths.

    A field that is an object in all records is its fields. One with values of several kinds, and a list
    that holds objects or values of several kinds, is any JSON. A field that is always null is text. What
    is no object has no fields. More than ``max_fields`` are refused.
    """
    parsed = df.select(F.try_parse_json(F.col(f"`{record}`")).alias("v"))
    objects = parsed.where(F.schema_of_variant("v").startswith("OBJECT"))
    told = objects.agg(F.schema_of_variant_agg("v")).first()[0]
    if not told.startswith("OBJECT<"):
        return []
    named = _MARK.sub(lambda m: m[0] if m[0][0] == "`" else "STRUCT<", told)
    fields = sorted(_leaves(T.DataType.fromDDL(named)), key=lambda f: f.path)
    if len(fields) > max_fields:
        raise ValueError(f"{len(fields)} fields, more than {max_fields}: {[f.name for f in fields[:5]]}, ...")
    return fields


def _value(parsed: Column, field: Field) -> Column:
    """The field's value as a column; NULL where a record lacks it."""
    at, path = parsed, "$"
    for name in field.path:
        quote = next((q for q in "'\"" if q not in name and "\\" not in name), None)
        if quote:
            path += f"[{quote}{name}{quote}]"
            continue
        # No path can spell this name.
        inner = at if path == "$" else F.try_variant_get(at, path, "variant")
        path = "$"
        at = F.try_element_at(F.from_json(F.to_json(inner), T.MapType(T.StringType(), T.VariantType())), F.lit(name))
    if field.dtype is None:
        return F.to_json(at if path == "$" else F.try_variant_get(at, path, "variant"))
    return F.try_variant_get(at, path, field.dtype.simpleString())


def flatten_discovered(
    df: DataFrame,
    record: str = "record",
    fields: list[Field] | None = None,
    max_fields: int = MAX_FIELDS,
) -> DataFrame:
    """Add a column for each field of the JSON objects in ``record``, by its dotted name.

    ``fields`` are those of an earlier :func:`discover_fields`: then nothing is discovered, as suits a
    stream, and values of another type are NULL. Fields of which there is a column already are left to
    it. Where names differ in case alone, later ones get a number. Any JSON is a text.
    """
    fields = discover_fields(df, record, max_fields) if fields is None else fields
    taken = {name.lower() for name in df.columns}
    fields = [f for f in fields if f.name.lower() not in taken]
    columns = []
    for field in fields:
        name, n = field.name, 1
        while name.lower() in taken:
            n += 1
            name = f"{field.name}_{n}"
        taken.add(name.lower())
        columns.append(_value(F.col("`_parsed`"), field).alias(name))
    parsed = df.withColumn("_parsed", F.try_parse_json(F.col(f"`{record}`")))
    return parsed.select(*(F.col(f"`{name}`") for name in df.columns), *columns)


def fields_schema(fields: list[Field]) -> T.StructType:
    """The columns of :func:`flatten_discovered`, for a store that keeps them."""
    return T.StructType([T.StructField(f.name, f.dtype or T.StringType()) for f in fields])
