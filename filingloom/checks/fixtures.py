"""Filings-shaped tables that Spark derives from the shared tables.

Every table is a projection of a whole shared table; stored tables are what an earlier run over the
filings with a given order status would have left behind.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from filingloom.functions.dates import render
from filingloom.sinks.workspace import new_folder, path_exists, staged

# As-of time of every registered query that needs one.
AS_OF = "2001-07-31 12:00:00"
# Days of the live window of the streams: about the last three years of orders.
STREAM_DAYS = 2200
# Days by which a trade may lie behind the latest one in a stream that goes by event time.
LATE_DAYS = 1100
EVENTS_AS_OF = "2024-01-30 12:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_KEPT: dict[tuple[str, str, str], str] = {}


def kept(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """Stored state that several queries start from: made once per session and folder of tables."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _KEPT or not path_exists(spark, _KEPT[key]):
        path = new_folder(spark, name)
        staged(build(), name, path)
        _KEPT[key] = path
    return spark.read.parquet(_KEPT[key])


def filed_at() -> Column:
    """Order date plus a time of day."""
    seconds = (F.col("o_orderkey") * 37) % 86400
    return F.col("o_orderdate") + F.expr("INTERVAL '1' SECOND") * seconds


def announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw announcements: one per order, with padded names, wrong suffixes, repeats, bad dates."""
    k = F.col("o_orderkey")
    name = F.when(k % 10 == 9, k - 1).otherwise(k).cast("string")
    suffix = F.when(k % 17 == 0, ".xml").when(k % 19 == 0, ".PDF").otherwise(".pdf")
    # What is used more than once has a step of its own: four parts of the time are taken.
    steps = {"_at": render(filed_at()), "_file": F.concat(name, suffix)}
    orders = table(spark, sf_dir, "orders").withColumns(steps)
    day, month, year, clock = (F.substring("_at", *p) for p in ((9, 2), (6, 2), (1, 4), (11, 9)))
    day_first = F.concat(day, F.lit("/"), month, F.lit("/"), year, clock)
    headline = F.substring("o_orderpriority", 1, 1)
    return orders.select(
        k.alias("ingest_seq"),
        F.concat(F.lit(" "), "_file").alias("AttachmentName"),
        (F.col("o_custkey") + 500000).cast("string").alias("SCRIP_CD"),
        F.when(k % 23 == 0, "n/a").otherwise(day_first).alias("Tradedate"),
        F.when(k % 11 == 0, "Annual Report")
        .when(k % 11 == 1, " Credit Rating ")
        .when(k % 11 == 2, "annual report")
        .alias("Descriptor"),
        F.when(headline == "1", "Investor PRESENTATION")
        .when(headline == "2", "Intimation of Credit Rating")
        .when(headline == "3", "Transcript of Conference Call")
        .when(headline == "4", "Board Meeting")
        .otherwise("Annual Report presentation")
        .alias("HeadLine"),
        F.concat(F.lit("  Body "), k.cast("string"), F.lit(" ")).alias("NewsBody"),
        F.concat(F.lit("https://example.org/"), "_file").alias("ATTACHMENTURL"),
        "o_orderstatus",
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company master rows: one per customer, with missing codes and excluded securities."""
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(c % 13 != 0, (c + 500000).cast("string")).alias("bsecode"),
        F.when(c % 3 == 0, F.lit(None))
        .when(c % 5 == 0, "")
        .otherwise(F.concat(F.lit("SYM"), c.cast("string")))
        .alias("nsesymbol"),
        F.concat(
            F.lit(" "), "c_name", F.when(c % 7 == 0, " Partly Paid").otherwise("\t")
        ).alias("companyname"),
        F.concat(
            F.when(c % 9 == 0, "IN9").otherwise("INE"), F.lpad(c.cast("string"), 9, "0")
        ).alias("isin"),
        F.col("c_acctbal").alias("mcap"),
        c.alias("load_seq"),
    )


def relisted_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A master in which three customers in a row share one code."""
    c = F.col("c_custkey")
    return companies(spark, sf_dir).withColumn(
        "bsecode", (F.floor(F.col("load_seq") / 3) + 500000).cast("string")
    )


def stored_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News ids an earlier run has stored: the finished orders."""
    return (
        table(spark, sf_dir, "orders")
        .where("o_orderstatus = 'F'")
        .select(F.col("o_orderkey").cast("string").alias("news_id"))
    )


# Fields of the records inside a reply.
EVENT_RECORD = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
    ]
)


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed replies, one per event; what it is depends on the day. A good one holds two records,
    or none for an error event."""
    day = F.dayofmonth("ts")
    record = F.struct("event_id", "user_id", "event_type")
    second = F.struct(
        "event_id", F.lit(None).cast("bigint").alias("user_id"), F.lit("copy").alias("event_type")
    )
    good = F.when(F.col("event_type") == "error", "[]").otherwise(
        F.to_json(F.array(record, second))
    )
    body = (
        F.when(day % 5 == 0, '{"Error_Msg": "No Record found"}')
        .when(day % 11 == 0, '{"Error_Msg": "Busy"}')
        .when(day % 13 == 0, '"text"')
        .when(day % 17 == 0, "<html>")
        .otherwise(good)
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("reply_id"),
        F.replace(F.col("ts").cast("date").cast("string"), F.lit("-"), F.lit("")).alias("tradedt"),
        F.when(day % 7 == 0, 500).otherwise(200).alias("status"),
        body.alias("body"),
    )


def mixed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of which some hold elements that are no records, and some end in other text."""
    k = F.col("event_id")
    record = F.to_json(F.struct("event_id", "event_type"))
    listed = F.concat(F.lit("["), record, F.lit("]"))
    body = (
        F.when(k % 6 == 0, F.concat(F.lit("["), record, F.lit(',7,"'), k.cast("string"), F.lit('"]')))
        .when(k % 6 == 1, F.concat(listed, F.lit(" tail")))
        .when(k % 6 == 2, F.concat(F.lit("["), record, F.lit(',{"event_id"')))
        .when(k % 6 == 3, F.translate(listed, '"', "'"))
        .when(k % 6 == 4, F.concat(F.lit("["), record, F.lit(","), record, F.lit("]")))
        .otherwise(record)
    )
    return table(spark, sf_dir, "events").select(
        k.alias("reply_id"), F.lit("20240101").alias("tradedt"), F.lit(200).alias("status"), body.alias("body")
    )


def nested_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON records whose fields differ from one to the next; some are no objects."""
    k = F.col("event_id")

    def text(column: Column | str) -> Column:
        return F.concat(F.lit('"'), column, F.lit('"'))

    level = F.when(k % 7 == 0, F.lit('"high"')).otherwise((k % 4).cast("string"))
    tags = F.concat(F.lit(',"tags":['), text("event_type"), F.lit(',"x"]'))
    record = F.concat(
        *(F.lit('{"user":{"id":'), F.col("user_id").cast("string"), F.lit(',"detail":{"kind":'), text("event_type")),
        *(F.lit('}},"level":'), level, F.when(k % 3 == 0, tags).otherwise("")),
        *(F.lit(',"extra":'), F.when(k % 5 == 0, F.lit("{}")).otherwise(F.col("props")), F.lit("}")),
    )
    return table(spark, sf_dir, "events").select("event_id", F.when(k % 11 == 0, "[1]").otherwise(record).alias("record"))


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times in eight spellings, some of them unreadable."""
    text = F.substring(F.col("ts").cast("string"), 1, 19)
    y, m, d, clock = (F.substring(text, *part) for part in ((1, 4), (6, 2), (9, 2), (12, 8)))
    spelling = F.col("event_id") % 8

    def joined(sep: str, *parts) -> Column:
        return F.concat_ws(sep, *parts)

    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_id") % 29 == 0, "bad")
        .when(spelling == 0, joined(" ", joined("-", y, m, d), clock))
        .when(spelling == 1, joined("-", y, m, d))
        .when(spelling == 2, joined(" ", joined("/", d, m, y), clock))
        .when(spelling == 3, joined("/", d, m, y))
        .when(spelling == 4, joined("", y, m, d))
        .when(spelling == 5, joined("-", d, m, y))
        .when(spelling == 6, joined(" ", joined("-", d, m, y), clock))
        .otherwise(joined("T", joined("-", y, m, d), clock))
        .alias("spelled"),
    )


def duplicated(reports: DataFrame, urgent_ids: DataFrame) -> DataFrame:
    """Stored reports with a row id, and a second, later copy of the urgent ones."""
    key = F.col("news_id").cast("bigint")
    first = reports.withColumn("row_id", key * 2)
    copies = first.join(urgent_ids, "news_id", "left_semi").withColumn("row_id", key * 2 + 1)
    return first.unionByName(copies)


def urgent_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where("o_orderpriority = '1-URGENT'")
        .select(F.col("o_orderkey").cast("string").alias("news_id"))
    )
