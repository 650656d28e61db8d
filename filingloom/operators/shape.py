"""Columns and unions: optional columns, defaults, flattening, bag union."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def optional(df: DataFrame, name: str, dtype: str | T.DataType = "string") -> Column:
    """The column, or typed NULLs when the table has no such column."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(dtype)


def with_default(df: DataFrame, name: str, value) -> DataFrame:
    """Add a constant column unless the table has it already."""
    return df if name in df.columns else df.withColumn(name, F.lit(value))


def flatten(df: DataFrame) -> DataFrame:
    """Turn nested structs into top-level columns with dotted names."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                source = ".".join(f"`{part}`" for part in here)
                yield F.col(source).alias(".".join(here))

    return df.select(*leaves(df.schema, ()))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by name; a column some inputs lack is NULL for their rows."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
