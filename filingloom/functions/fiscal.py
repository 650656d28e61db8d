"""Financial calendar (April to March) and report identifiers."""

from pyspark.sql import Column, functions as F

# Months up to and including the bound belong to the quarter.
QUARTER_BOUNDS = [0, 3, 6, 9, 12]
QUARTER_LABELS = ["Q3", "Q4", "Q1", "Q2"]
# Quarters that belong to the financial year before the calendar year.
EARLIER_YEAR_QUARTERS = ["Q3", "Q4"]


def bucketize(value: Column, bounds: list, labels: list[str], include_lowest: bool = False) -> Column:
    """Label of the interval (low, high] a value falls in; NULL outside all of them."""
    result = F.lit(None).cast("string")
    for position in reversed(range(len(labels))):
        low, high = bounds[position], bounds[position + 1]
        above = value >= low if include_lowest and position == 0 else value > low
        result = F.when(above & (value <= high), F.lit(labels[position])).otherwise(result)
    return result


def _quarter_of(month: int) -> str:
    return next(label for label, bound in zip(QUARTER_LABELS, QUARTER_BOUNDS[1:]) if month <= bound)


def fiscal_quarter(ts: Column) -> Column:
    """Looked up by month, which is worked out once, not once per bound."""
    by_month = F.array(*(F.lit(_quarter_of(month)) for month in range(1, 13)))
    return F.get(by_month, F.month(ts) - F.lit(1))


def fiscal_year(ts: Column) -> Column:
    shift = F.when(fiscal_quarter(ts).isin(EARLIER_YEAR_QUARTERS), 1).otherwise(0)
    return (F.year(ts) - shift).cast("bigint")


def base_report_id(company: Column, code: Column, ts: Column) -> Column:
    """``company_CODE_FYyearQn``. The year here is the calendar year; NULL if any part is NULL."""
    return F.concat(
        company, F.lit("_"), code, F.lit("_FY"), F.year(ts).cast("string"), fiscal_quarter(ts)
    )


def report_id(base: Column, number: Column) -> Column:
    return F.concat(base, F.lit("_"), number.cast("string"))
