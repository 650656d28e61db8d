"""Raw announcements to clean, categorised ones."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from filingloom.functions.categories import category, folded
from filingloom.functions.dates import parse_trade_date, render
from filingloom.functions.text import WHITESPACE, normalised, strip, strip_strings, without_last_chars
from filingloom.operators.keys import keep_first, without_keys
from filingloom.operators.shape import optional
from filingloom.rules import CATEGORY_RULES, DEFAULT_CATEGORY, Rule

# Fixed value: attachments that count.
ATTACHMENT_SUFFIX = ".pdf"


def with_attachment(
    df: DataFrame,
    attachment: str = "AttachmentName",
    suffix: str = ATTACHMENT_SUFFIX,
    into: str = "news_id",
) -> DataFrame:
    """Rows whose attachment ends in the suffix; the name without it becomes the id.

    Spark tests the suffix before it makes the stripped name, so the test strips only where the name as
    it is does not tell.
    """
    name = F.col(attachment)
    listed = strip(name).endswith(suffix)
    if suffix == suffix.strip(WHITESPACE):
        listed = name.endswith(suffix) | listed
    return (
        df.where(listed)
        .withColumn(attachment, strip(name))
        .withColumn(into, without_last_chars(name, len(suffix)))
    )


def _with_code(df: DataFrame, code: str) -> DataFrame:
    """Rows with a company code, stripped. It is never NULL, which spares the join a test that strips again."""
    known = df.where(F.col(code).isNotNull())
    return known.withColumn(code, F.coalesce(strip(F.col(code)), F.lit("")))


def known_company(df: DataFrame, master: DataFrame, code: str = "SCRIP_CD") -> DataFrame:
    """Rows of companies in the master."""
    return _with_code(df, code).join(master.select(code), code, "left_semi")


def enrich_company(df: DataFrame, master: DataFrame, code: str = "SCRIP_CD") -> DataFrame:
    """Add ``company`` and ``symbolmap``; rows of unknown companies go.

    No broadcast hint: Spark broadcasts the master while it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by shuffle, where adaptive
    execution splits the partition of a company with very many filings.
    """
    return _with_code(df, code).join(master, code)


def with_trade_date(df: DataFrame, column: str = "Tradedate", into: str = "dt") -> DataFrame:
    """Parse the trade date, drop rows without a valid one and render it in sortable form.

    Taken out of an array, the date is parsed once; Spark would parse a plain column again for the test.
    """
    return (
        df.withColumn(into, F.explode(F.array(parse_trade_date(strip(F.col(column))))))
        .where(F.col(into).isNotNull())
        .withColumn(column, render(F.col(into)))
    )


def categorise(
    df: DataFrame,
    rules: Sequence[Rule] = CATEGORY_RULES,
    descriptor: str = "Descriptor",
    headline: str = "HeadLine",
    body: str = "NewsBody",
    default: str = DEFAULT_CATEGORY,
    into: str = "category",
) -> DataFrame:
    """Add the category. A text column the table lacks matches nothing.

    Each text is folded once for all rules, in a step of its own.
    """
    texts = {"_headline": headline, "_body": body}
    folds = df.withColumns({name: folded(optional(df, text)) for name, text in texts.items()})
    found = category(
        optional(df, descriptor), F.col("_headline"), F.col("_body"), rules, default
    )
    return folds.withColumn(into, found).drop(*texts)


def _tidy_text(df: DataFrame, preserve_case: bool) -> DataFrame:
    if preserve_case:
        return strip_strings(df)
    return df.withColumns(
        {
            "HeadLine": normalised(F.col("HeadLine")),
            "NewsBody": F.coalesce(normalised(F.col("NewsBody")), F.lit("")),
            "Descriptor": strip(F.col("Descriptor")),
        }
    )


def clean_announcements(
    raw: DataFrame,
    master: DataFrame,
    stored_ids: DataFrame | None = None,
    *,
    rules: Sequence[Rule] = CATEGORY_RULES,
    order_by: Sequence[str] = ("ingest_seq",),
    dedup: str = "before_parse",
    preserve_case: bool = False,
    narrow_first: bool = False,
) -> DataFrame:
    """New, valid, categorised announcements, one per ``news_id``.

    ``dedup="before_parse"`` takes the first row of an id even if its date turns out bad and the id
    is lost; ``"after_parse"`` takes the first row with a good date. The shuffle of the first-row
    choice also serves the exclusion of stored ids.
    """
    if dedup not in ("before_parse", "after_parse"):
        raise ValueError(f"dedup must be before_parse or after_parse, not {dedup!r}")
    rows = enrich_company(with_attachment(raw), master)
    if dedup == "after_parse":
        rows = with_trade_date(rows)
    rows = keep_first(rows, "news_id", order_by)
    if stored_ids is not None:
        rows = without_keys(rows, stored_ids, "news_id", narrow_first, unique=True)
    if dedup == "before_parse":
        rows = with_trade_date(rows)
    return categorise(_tidy_text(rows, preserve_case), rules)
