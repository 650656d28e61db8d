"""Explicit schemas of the tables this library reads and writes."""

from pyspark.sql import types as T


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


SYMBOLMAP = _struct(
    NSE=T.StringType(), BSE=T.LongType(), Company_Name=T.StringType(), SELECTED=T.StringType()
)

RAW_ANNOUNCEMENT = _struct(
    AttachmentName=T.StringType(),
    SCRIP_CD=T.StringType(),
    Tradedate=T.StringType(),
    Descriptor=T.StringType(),
    HeadLine=T.StringType(),
    NewsBody=T.StringType(),
    ATTACHMENTURL=T.StringType(),
)

COMPANY_MASTER = _struct(
    bsecode=T.StringType(),
    nsesymbol=T.StringType(),
    companyname=T.StringType(),
    isin=T.StringType(),
    mcap=T.DoubleType(),
    load_seq=T.LongType(),
)

# Stored announcements: the raw fields, the whole landed record as text, what enrichment added, and
# two partition columns.
ANNOUNCEMENTS = T.StructType(
    RAW_ANNOUNCEMENT.fields
    + _struct(
        record=T.StringType(),
        news_id=T.StringType(),
        company=T.StringType(),
        symbolmap=SYMBOLMAP,
        category=T.StringType(),
        dt=T.TimestampNTZType(),
        trade_period=T.DateType(),
        batch=T.StringType(),
    ).fields
)

REPORTS = _struct(
    company=T.StringType(),
    symbolmap=SYMBOLMAP,
    news_id=T.StringType(),
    datecode=T.StringType(),
    Year=T.LongType(),
    Qtr=T.StringType(),
    dt_tm=T.StringType(),
    url=T.StringType(),
    report_id=T.StringType(),
    report_line=T.StringType(),
    count=T.LongType(),
    document_date=T.StringType(),
    quarter_start=T.DateType(),
    report_type=T.StringType(),
    batch=T.StringType(),
)

# One landed HTTP reply: the day it was asked for, its status and its body.
RESPONSE = _struct(tradedt=T.StringType(), status=T.IntegerType(), body=T.StringType())
