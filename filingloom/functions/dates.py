"""Zone-free date functions: everything works on TIMESTAMP_NTZ and never asks the session zone."""

import re
from datetime import datetime

from pyspark.sql import Column, functions as F

# Fixed value: how announcements spell their trade date.
TRADE_DATE_FORMAT = "%d/%m/%Y %H:%M:%S"

# Spellings accepted for a cursor or range bound, tried in this order.
DATE_FORMATS = [
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%d",
    "%d/%m/%Y %H:%M:%S",
    "%d/%m/%Y",
    "%Y%m%d",
    "%d-%m-%Y",
    "%d-%m-%Y %H:%M:%S",
    "%Y-%m-%dT%H:%M:%S",
]

# What each strptime directive accepts.
_DIRECTIVES = {
    "Y": r"(?!0000)\d{4}",
    "m": r"1[0-2]|0[1-9]|[1-9]",
    "d": r"3[01]|[12]\d|0[1-9]|[1-9]",
    "H": r"2[0-3]|[01]\d|\d",
    "M": r"[0-5]\d|\d",
    "S": r"[0-5]\d|\d",
}


def _pattern_and_iso(fmt: str) -> tuple[str, str]:
    """Regular expression for a strptime format and the replacement that turns it into ISO."""
    group = {}
    pattern = ""
    for piece in re.findall(r"%[YmdHMS]|\s+|.", fmt):
        if len(piece) == 2 and piece[0] == "%":
            group[piece[1]] = f"${len(group) + 1}"
            pattern += f"({_DIRECTIVES[piece[1]]})"
        else:
            pattern += r"\s+" if piece.isspace() else re.escape(piece)
    iso = "{Y}-{m}-{d}".format(**group)
    if "H" in group:
        iso += " {H}:{M}:{S}".format(**group)
    return pattern, iso


def parse_timestamp(text: Column, *formats: str) -> Column:
    """Parse with the first strptime format that fits; NULL when none does or no such day exists.

    Text that does not fit takes the second branch of the pattern, where all groups are empty, and
    what is left of the replacement is no timestamp.
    """
    attempts = []
    for fmt in formats:
        pattern, iso = _pattern_and_iso(fmt)
        as_iso = F.regexp_replace(text, rf"(?s)\A{pattern}\z|\A.*\z", iso)
        attempts.append(as_iso.try_cast("timestamp_ntz"))
    return F.coalesce(*attempts)


def parse_trade_date(text: Column) -> Column:
    return parse_timestamp(text, TRADE_DATE_FORMAT)


def parse_any_date(text: Column) -> Column:
    return parse_timestamp(text, *DATE_FORMATS)


def render(ts: Column) -> Column:
    """``YYYY-mm-dd HH:MM:SS``."""
    return F.substring(ts.cast("string"), 1, 19)


def datecode(ts: Column) -> Column:
    """``YYYYmmdd``."""
    return F.replace(ts.cast("date").cast("string"), F.lit("-"), F.lit(""))


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def day_start(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def minute_start(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 1, 16).cast("timestamp_ntz")


def period_start(ts: Column, period: str) -> Column:
    """First date of the day, month, quarter or year."""
    return ts.cast("date") if period == "day" else F.trunc(ts.cast("date"), period)


def days_before(ts: Column, days: int) -> Column:
    """Midnight of the day that lies ``days`` days before."""
    return F.date_sub(ts.cast("date"), days).cast("timestamp_ntz")


def timestamp(value: str | datetime) -> Column:
    """A TIMESTAMP_NTZ literal."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")
