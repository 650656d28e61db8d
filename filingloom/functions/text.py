"""Text functions."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed value: every character Unicode counts as white space, plus the four ASCII separators.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The ASCII part of it, the commonest first.
ASCII_WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"


def strip(text: Column) -> Column:
    """Remove white space of every kind from both ends (``trim`` removes blanks only).

    Every character at an end is searched in the list byte by byte, so ASCII text has the short list.
    """
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.btrim(text, F.lit(ASCII_WHITESPACE))).otherwise(
        F.btrim(text, F.lit(WHITESPACE))
    )


def strip_strings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``strip`` the given string columns, or every string column."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: strip(F.col(f"`{name}`")) for name in names})


def normalised(text: Column) -> Column:
    """Lower-cased and stripped, as rules see it."""
    return strip(F.lower(text))


def without_last_chars(text: Column, n: int) -> Column:
    return F.left(text, F.length(text) - F.lit(n))


def without_last_part(text: Column, separator: str = "_") -> Column:
    """Everything before the last separator; empty when there is none."""
    last = F.substring_index(text, separator, -1)
    return F.left(text, F.length(text) - F.length(last) - F.lit(len(separator)))


def non_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""
