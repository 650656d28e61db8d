"""Column functions against plain Python on hand-written values."""

import random
from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F

from filingloom.functions.categories import folded, matches
from filingloom.functions.dates import (
    DATE_FORMATS,
    TRADE_DATE_FORMAT,
    datecode,
    day_start,
    days_before,
    minute_start,
    parse_any_date,
    parse_trade_date,
    period_start,
    render,
    timestamp,
)
from filingloom.functions.fiscal import base_report_id, bucketize, fiscal_quarter, fiscal_year
from filingloom.functions.text import strip, strip_strings, without_last_chars, without_last_part
from filingloom.operators.announcements import categorise
from filingloom.rules import CATEGORY_RULES, Rule


def values(spark, rows, column, schema="v string"):
    df = spark.createDataFrame([(row,) for row in rows], schema)
    return [r[0] for r in df.select(column).collect()]


def python_parse(text, formats):
    for fmt in formats:
        try:
            return str(datetime.strptime(text, fmt))
        except ValueError:
            continue
    return None


TEXTS = [
    "01/09/2025 10:11:12", "1/9/2025 1:2:3", "31/12/2025 23:59:59", "30/02/2025 01:00:00",
    "29/02/2024 00:00:00", "29/02/2023 00:00:00", "01/13/2025 00:00:00", "01/09/2025 24:00:00",
    "01/09/2025 10:60:00", "01/09/2025 10:11:60", "01/09/2025", "2025-09-03", "2025-9-3 1:2:3",
    "2025-09-03T01:02:03", "2025-09-03 01:02:03", "20250903", "2025111", "2025131", "202513",
    "3-9-2025", "03-09-2025 10:00:00", "3-9-2025T10:00:00", "09/03/2025 02:30:00", "n/a", "", "x",
    "01/09/25 10:11:12", "01/09/2025  10:11:12", "01/09/2025 10:11:12 ", "a01/09/2025 10:11:12",
    "01/09/2025 10:11:12.5", "00/09/2025 10:11:12", "01/00/2025 10:11:12", "9999-12-31",
    "01/09/2025\t10:11:12", "2025-09-03Z", "+2025-09-03", "2025-09-03 01:02:03+05:30",
    "01/09/2025 10:11:12\n",
]


def test_trade_date_like_strptime(spark):
    got = values(spark, TEXTS, render(parse_trade_date(F.col("v"))))
    assert got == [python_parse(t, [TRADE_DATE_FORMAT]) for t in TEXTS]


def test_any_date_like_strptime(spark):
    got = values(spark, TEXTS, render(parse_any_date(F.col("v"))))
    assert got == [python_parse(t, DATE_FORMATS) for t in TEXTS]


def test_random_dates_like_strptime(spark):
    pick = random.Random(7)

    def part():
        number = pick.randrange(40)
        return pick.choice([str(number), f"{number:02d}", "2025"])

    def text():
        sep, middle, colon = (pick.choice(["/", "-", ":", " ", "T", ""]) for _ in range(3))
        date = sep.join(part() for _ in range(3))
        return pick.choice([date, date + middle + colon.join(part() for _ in range(3))])

    texts = [text() for _ in range(20_000)]
    expected = [python_parse(t, DATE_FORMATS) for t in texts]
    assert sum(e is not None for e in expected) > 100
    assert values(spark, texts, render(parse_any_date(F.col("v")))) == expected


def test_null_dates(spark):
    assert values(spark, [None], render(parse_any_date(F.col("v")))) == [None]


def test_times_in_a_clock_change_stay(spark):
    text = "09/03/2025 02:30:00"
    ts = parse_trade_date(F.col("v"))
    out = F.concat_ws("|", render(ts), datecode(ts), F.hour(ts), render(day_start(ts)))
    assert values(spark, [text], out) == ["2025-03-09 02:30:00|20250309|2|2025-03-09 00:00:00"]


def test_date_arithmetic(spark):
    ts = timestamp("2025-03-01 10:20:30")
    out = F.concat_ws(
        "|",
        render(days_before(ts, 4)),
        render(minute_start(ts)),
        *[period_start(ts, p).cast("string") for p in ("day", "month", "quarter", "year")],
    )
    assert values(spark, ["x"], out) == [
        "2025-02-25 00:00:00|2025-03-01 10:20:00|2025-03-01|2025-03-01|2025-01-01|2025-01-01"
    ]


def test_strip_like_python(spark):
    texts = [" a ", "\t\n a b\r\x0b\x0c", " x　", "\x1c\x1dy\x85", "", "  ", "​z", None]
    got = values(spark, texts, strip(F.col("v")))
    assert got == [t if t is None else t.strip() for t in texts]


def test_strip_of_ascii_and_other_texts_like_python(spark):
    ends = ["", " ", "\t\x1f", "\xa0", "\u3000 ", "\x85\n"]
    texts = [a + core + b for core in ("x", "é y", "") for a in ends for b in ends]
    got = values(spark, texts, strip(F.col("v")))
    assert got == [t.strip() for t in texts]


def test_strip_strings_leaves_other_types(spark):
    df = spark.createDataFrame([(1, " a ", " b ")], "n int, `x.y` string, z string")
    assert strip_strings(df).collect()[0] == (1, "a", "b")
    assert strip_strings(df, ["z"]).collect()[0] == (1, " a ", "b")


def test_cuts_like_python(spark):
    texts = ["a_b_c", "a", "a_", "_a", "", "x\ny_z", None]
    got = values(spark, texts, without_last_part(F.col("v")))
    assert got == [t if t is None else "_".join(t.split("_")[:-1]) for t in texts]
    texts = ["abc.pdf", ".pdf", "pdf", "", None]
    got = values(spark, texts, without_last_chars(F.col("v"), 4))
    assert got == [t if t is None else t[:-4] for t in texts]


def test_bucketize_like_cut(spark):
    numbers = [-1, 0, 1, 3, 4, 6, 7, 9, 10, 12, 13]
    bounds, labels = [0, 3, 6, 9, 12], ["a", "b", "c", "d"]
    for lowest in (False, True):
        got = values(spark, numbers, bucketize(F.col("v"), bounds, labels, lowest), "v int")
        cut = pd.cut(pd.Series(numbers), bins=bounds, labels=labels, include_lowest=lowest)
        assert got == [None if pd.isna(x) else x for x in cut]


def test_fiscal_calendar(spark):
    days = [f"2025-{month:02d}-15" for month in range(1, 13)]
    ts = F.col("v").cast("timestamp_ntz")
    got = values(spark, days, F.concat(fiscal_quarter(ts), fiscal_year(ts).cast("string")))
    assert got == ["Q32024"] * 3 + ["Q42024"] * 3 + ["Q12025"] * 3 + ["Q22025"] * 3


def test_base_id_keeps_the_calendar_year_and_needs_a_company(spark):
    ts = timestamp("2025-02-10 00:00:00")
    got = values(spark, ["INE1", None], base_report_id(F.col("v"), F.lit("CR"), ts))
    assert got == ["INE1_CR_FY2025Q3", None]


def categories(spark, rows, rules=CATEGORY_RULES):
    df = spark.createDataFrame(rows, "d string, h string, b string")
    return [r.category for r in categorise(df, rules, "d", "h", "b").collect()]


def test_rule_order_and_descriptor(spark):
    rows = [
        ("Credit Rating", "presentation", None),
        ("  Credit Rating\t", "x", None),
        ("credit rating", "x", None),
        (None, "Annual Report PRESENTATION", None),
        (None, "annual  report", None),
        (None, "earnings CALL", None),
        (None, "the transcript", None),
        (None, None, "presentation"),
        ("General", "credit rating", None),
        (None, "preſentation", None),
        (None, "Earningſ Call", None),
    ]
    assert categories(spark, rows) == [
        "Credit Rating",
        "Credit Rating",
        "General",
        "Investor Presentation",
        "General",
        "Earnings Call Transcript",
        "Earnings Call Transcript",
        "General",
        "Credit Rating",
        "Investor Presentation",
        "Earnings Call Transcript",
    ]


def test_body_rules_and_regular_expressions(spark):
    rules = [
        Rule("Both", headline=r"q[1-4]\s+results", body="dividend"),
        Rule("Body", body="bonus (issue|shares)"),
        Rule("Upper", headline=r"\bAGM\b\S"),
        Rule("Nothing"),
    ]
    rows = [
        (None, "Q3  Results", None),
        (None, None, "Interim DIVIDEND"),
        (None, "x", "Bonus Issue"),
        (None, "bonus issue", "x"),
        (None, "the agm: x", "x"),
        ("Nothing", None, None),
    ]
    assert categories(spark, rows, rules) == ["Both", "Both", "Body", "General", "Upper", "Nothing"]


def test_plain_words_and_patterns_agree(spark):
    texts = ["A Conference CALL", "conferencecall", "", None, "transcripts", "call"]
    plain = values(spark, texts, matches(folded(F.col("v")), "conference call|transcript"))
    regex = values(spark, texts, matches(folded(F.col("v")), "(conference call|transcript)"))
    assert plain == regex == [True, False, False, False, True, False]
