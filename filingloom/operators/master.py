"""Company master: which companies count, and what an announcement takes from them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from filingloom.functions.text import strip
from filingloom.operators.keys import keep_last

# Marks of securities that are left out.
EXCLUDED_ISIN = "IN9"
EXCLUDED_NAME = r"(?i)partly\s?paid"


def valid_company() -> Column:
    """Has a code and a market value; not an excluded security. NULL text excludes nothing."""

    def lacks(text: Column, pattern: str) -> Column:
        return ~F.coalesce(text.rlike(pattern), F.lit(False))

    return (
        F.col("bsecode").isNotNull()
        & (F.col("mcap") > 0)
        & lacks(F.col("isin"), EXCLUDED_ISIN)
        & lacks(F.col("companyname"), EXCLUDED_NAME)
    )


def company_master(df: DataFrame, order_by: Sequence[str] = ("load_seq",)) -> DataFrame:
    """One row per company code: ``SCRIP_CD, company, symbolmap``.

    Of several valid rows with one code the last in ``order_by`` counts. Codes that are not whole
    numbers are left out.
    """
    code = F.col("bsecode").try_cast("bigint")
    symbol = F.col("nsesymbol")
    valid = df.where(valid_company()).withColumn("_code", code).where("_code is not null")
    # Ranked by the number, joined by its text: so a join gets a shuffle of its own, which adaptive
    # execution can split where one company is crowded.
    return keep_last(valid, "_code", order_by).select(
        F.col("_code").cast("string").alias("SCRIP_CD"),
        F.col("isin").alias("company"),
        F.struct(
            symbol.alias("NSE"),
            F.col("_code").alias("BSE"),
            strip(F.coalesce("companyname", F.lit(""))).alias("Company_Name"),
            F.coalesce(F.nullif(symbol, F.lit("")), F.col("_code").cast("string")).alias("SELECTED"),
        ).alias("symbolmap"),
    )
