"""One registered query per operator, each over whole shared tables."""

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from filingloom.checks import fixtures as fx
from filingloom.functions.categories import report_code
from filingloom.functions.dates import (
    datecode,
    day_start,
    parse_any_date,
    parse_trade_date,
    render,
)
from filingloom.functions.fiscal import bucketize, fiscal_quarter, fiscal_year
from filingloom.functions.text import strip_strings, without_last_part
from filingloom.operators import announcements as ann
from filingloom.operators import counts, keys, master, numbering, reports, shape
from filingloom.operators.discovered import flatten_discovered
from filingloom.operators.rule_table import categorise_by_table
from filingloom.plans import backfill
from filingloom.plans.backfill import backfill_plan
from filingloom.plans.compact import compact
from filingloom.plans.duplicates import remove_duplicates
from filingloom.plans.ingest import Store, run_batch, store_announcements
from filingloom.plans.recheck import recheck
from filingloom.rules import Rule
from filingloom.schemas import REPORTS
from filingloom.sinks.archive import archive_jsonl
from filingloom.sinks.tables import append_new_only
from filingloom.sinks.workspace import new_folder, staged
from filingloom.sources import landed, requests, stored
from filingloom.streaming.live import run_stream

ORDER_SEQ = T.StructType([T.StructField("order_seq", T.LongType())])

TEXT_RULES = [
    Rule("Licence", headline="licen[cs]e|copyright"),
    Rule("Contact", headline="@[a-z]+[.]|phone|e-mail"),
    Rule("Long words", headline="[a-z]{14}"),
    Rule("The", headline=" the ", body="src1"),
]


def big(column: Column) -> Column:
    return column.cast("bigint")


def flat_symbols(df: DataFrame) -> DataFrame:
    """``symbolmap`` as plain columns."""
    parts = {"nse": "NSE", "bse": "BSE", "company_name": "Company_Name", "selected": "SELECTED"}
    return df.withColumns(
        {name: F.col(f"symbolmap.{field}") for name, field in parts.items()}
    ).drop("symbolmap")


# --- shared steps -----------------------------------------------------------------------------


def clean(spark: SparkSession, sf: str, **options) -> DataFrame:
    raw, companies = fx.announcements(spark, sf), fx.companies(spark, sf)
    return ann.clean_announcements(raw, master.company_master(companies), **options)


def earlier_announcements(spark: SparkSession, sf: str) -> DataFrame:
    """Clean announcements of an earlier run, which saw the finished orders only."""
    raw = fx.announcements(spark, sf).where("o_orderstatus = 'F'")
    return ann.clean_announcements(raw, master.company_master(fx.companies(spark, sf)))


def earlier_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of that earlier run."""
    return fx.kept(spark, sf, "earlier", lambda: _reports_of(spark, earlier_announcements(spark, sf)))


def all_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Stored reports of all orders."""
    return fx.kept(spark, sf, "all", lambda: _reports_of(spark, clean(spark, sf)))


def _reports_of(spark: SparkSession, announcements: DataFrame) -> DataFrame:
    rows = staged(announcements, "announcements")
    return reports.build_reports(rows, stored.empty_table(spark, REPORTS), fx.AS_OF)


def _duplicated(spark, sf):
    ids = fx.urgent_ids(spark, sf)
    return fx.kept(spark, sf, "copies", lambda: fx.duplicated(all_reports(spark, sf), ids))


def _duplicated_keys(spark, sf):
    """``row_id, news_id, report_id`` of the reports and their copies: no other column is moved or kept."""

    def build():
        told = reports.report_candidates(clean(spark, sf)).select("company", "news_id", "category", "dt")
        ids = _reports_of(spark, told).select("news_id", "report_id")
        return fx.duplicated(staged(ids, "report-keys"), fx.urgent_ids(spark, sf))

    return fx.kept(spark, sf, "copied-keys", build)


def report_columns(df: DataFrame) -> DataFrame:
    return flat_symbols(df).drop("quarter_start")


# --- sources ----------------------------------------------------------------------------------


def src_announcements(spark, sf):
    path = new_folder(spark, "landed")
    raw = fx.announcements(spark, sf).withColumnRenamed("ingest_seq", "order_seq")
    raw.write.json(path)
    return landed.read_announcements(spark, path, extra=ORDER_SEQ).drop("ingest_seq", "record")


def src_array_layout(spark, sf):
    """JSON arrays of up to five thousand records, each a file: more orders are more files."""
    path = new_folder(spark, "arrays")
    rows = fx.announcements(spark, sf).withColumnRenamed("ingest_seq", "order_seq")
    arrays = rows.groupBy(F.floor(F.col("order_seq") / 5000).alias("part")).agg(
        F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value")
    )
    arrays.write.partitionBy("part").text(path)
    found = landed.read_announcements(spark, f"{path}/*", "array", extra=ORDER_SEQ)
    return found.drop("ingest_seq", "record")


def src_big_arrays(spark, sf):
    """All announcements in a few long lists, each read by as many tasks as the file has blocks."""
    path = new_folder(spark, "lists")
    rows = fx.announcements(spark, sf).withColumnRenamed("ingest_seq", "order_seq")
    part = F.floor(F.col("order_seq") / 200_000).alias("part")
    order = Window.partitionBy("part").orderBy("order_seq")
    before = F.when(F.lag("order_seq").over(order).isNull(), "[").otherwise(",")
    after = F.when(F.lead("order_seq").over(order).isNull(), "]").otherwise("")
    record = F.to_json(F.struct(*rows.columns))
    lines = rows.select(part, "order_seq", record.alias("record"))
    texts = lines.select("part", "order_seq", F.concat(before, F.col("record"), after).alias("value"))
    texts.sortWithinPartitions("part", "order_seq").select("part", "value").write.partitionBy("part").text(path)
    return landed.read_announcements(spark, f"{path}/*", "big_array", extra=ORDER_SEQ).drop("ingest_seq", "record")


def src_rejects(spark, sf):
    """Lines of which some are cut, some no object and some followed by more text."""
    path = new_folder(spark, "broken")
    rows = fx.announcements(spark, sf).withColumnRenamed("ingest_seq", "order_seq")
    line, k = F.to_json(F.struct("order_seq", "AttachmentName")), F.col("order_seq")
    broken = (
        F.when(k % 7 == 0, F.left(line, F.length(line) - 5))
        .when(k % 7 == 1, k.cast("string"))
        .when(k % 7 == 2, F.concat(line, F.lit(" x")))
        .when(k % 7 == 3, F.concat(F.lit("["), line, F.lit("]")))
        .otherwise(line)
    )
    rows.select(broken.alias("value")).write.text(path)
    good = landed.read_announcements(spark, path, extra=ORDER_SEQ)
    rejects = landed.read_rejects(spark, path)
    return rejects.select("record", F.lit(0).alias("good")).unionByName(
        good.select("record", F.lit(1).alias("good"))
    )


def response_rejects(spark, sf):
    """Bodies and elements of replies that hold no record."""
    mixed = landed.triage(fx.mixed_responses(spark, sf))
    return landed.rejected_records(mixed).select("reply_id", "position", "reason", "text")


def response_mixed(spark, sf):
    """Records of the same replies."""
    found = landed.records(landed.triage(fx.mixed_responses(spark, sf)), fx.EVENT_RECORD)
    return found.select("reply_id", "position", "event_id", "event_type")


def response_triage(spark, sf):
    return landed.triage(fx.responses(spark, sf)).select(
        "reply_id",
        "tradedt",
        "status_class",
        F.when(F.col("status_class") == "ok", landed.record_count(F.col("body")))
        .otherwise(F.lit(0))
        .alias("n_records"),
    )


def response_records(spark, sf):
    return landed.records(landed.triage(fx.responses(spark, sf)), fx.EVENT_RECORD).select(
        "reply_id", "tradedt", "position", "event_id", "user_id", "event_type"
    )


def per_day_counts(spark, sf):
    rows = landed.records(landed.triage(fx.responses(spark, sf)), fx.EVENT_RECORD)
    return counts.counts_with_total(rows, "tradedt")


def order_ranges(spark, sf):
    """One history range per run: from the first to the last order date."""
    return fx.table(spark, sf, "orders").agg(
        F.min("o_orderdate").alias("from_dt"), F.max(fx.filed_at()).alias("to_dt")
    )


def date_spine_hist(spark, sf):
    days = requests.day_spine(order_ranges(spark, sf))
    return days.select(render(F.col("request_ts")).alias("request_ts"))


def range_clamp(spark, sf):
    """Each order asks for a range that starts with it and ends a price-dependent time off."""
    hours = F.floor(F.col("o_totalprice") % 5000).cast("int") - 2000
    asked = fx.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", fx.filed_at()).alias("from_dt"),
        F.when(
            F.col("o_orderpriority") != "5-LOW", fx.filed_at() + F.make_dt_interval(hours=hours)
        ).alias("to_dt"),
    )
    clamped = requests.clamp_range(
        asked, earliest="1996-03-01 00:00:00", latest="2000-10-31 00:00:00"
    )
    return clamped.select(
        "o_orderkey", render(F.col("from_dt")).alias("from_dt"), render(F.col("to_dt")).alias("to_dt")
    )


def user_cursors(spark, sf):
    """Each user's last event time as text, in the spelling of that event."""
    return (
        fx.date_texts(spark, sf)
        .groupBy("user_id")
        .agg(F.max_by("spelled", "event_id").alias("cursor"))
    )


def date_spine_live(spark, sf):
    plan = requests.live_spine(user_cursors(spark, sf), fx.EVENTS_AS_OF)
    return plan.select("user_id", "cursor", render(F.col("request_ts")).alias("request_ts"))


def date_spine_live_literal(spark, sf):
    plan = requests.live_spine(user_cursors(spark, sf), fx.EVENTS_AS_OF, literal=True)
    return plan.select("user_id", "cursor", render(F.col("request_ts")).alias("request_ts"))


def request_plan(spark, sf):
    plan = requests.live_spine(user_cursors(spark, sf), fx.EVENTS_AS_OF, literal=True)
    return requests.request_plan(plan).select("user_id", "tradedt", "hr", "min", "sec")


def backfill_gaps(spark, sf):
    ranges = fx.table(spark, sf, "events").agg(
        day_start(F.min("ts")).alias("from_dt"), F.max("ts").alias("to_dt")
    )
    got = landed.records(landed.triage(fx.responses(spark, sf)), fx.EVENT_RECORD)
    plan = backfill_plan(
        ranges, got, earliest="2024-01-01 00:00:00", latest="2024-12-31 00:00:00"
    )
    return plan.select("tradedt", "hr", "min", "sec")


def retry_plan_query(spark, sf):
    """What is next for each day, and for each of 97 parts of its replies, which end in all states."""
    days = fx.table(spark, sf, "events").agg(day_start(F.min("ts")).alias("from_dt"), F.max("ts").alias("to_dt"))
    plan = requests.request_plan(requests.day_spine(days)).select("tradedt")
    replies = landed.triage(fx.responses(spark, sf)).join(
        fx.table(spark, sf, "events").select(F.col("event_id").alias("reply_id"), "ts"), "reply_id"
    )
    got = (F.col("status_class") == "ok") & (landed.record_count(F.col("body")) > 0)
    told = backfill.retry_plan(plan, replies, fx.EVENTS_AS_OF, at="ts", succeeded=got)
    part = F.concat_ws("-", "tradedt", F.col("reply_id") % 97)
    parts = replies.select(part.alias("tradedt"), "ts", got.alias("succeeded"))
    each = backfill.retry_plan(parts.select("tradedt").distinct(), parts, fx.EVENTS_AS_OF, at="ts")
    both = told.unionByName(each)
    return both.withColumn("not_before", render(F.date_trunc("second", "not_before")))


def cursor_log_query(spark, sf):
    """The cursor of each user's runs, which catch up at every purchase."""
    runs = fx.table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("stream"), F.col("ts").alias("started_at"), (F.col("event_type") == "purchase").alias("caught_up")
    )
    found = backfill.cursor_log(runs)
    return found.select("event_id", *(render(F.col(c)).alias(c) for c in ("cursor_before", "cursor_after")))


def union_days(spark, sf):
    raw = fx.announcements(spark, sf)
    parts = [
        raw.where("o_orderstatus = 'F'"),
        raw.where("o_orderstatus = 'O'").drop("ATTACHMENTURL"),
        raw.where("o_orderstatus = 'P'").drop("Descriptor"),
    ]
    return shape.union_all(parts)


def existing_news_ids(spark, sf):
    return stored.existing_news_ids(clean(spark, sf), "1998-01-15 10:00:00")


def existing_report_ids(spark, sf):
    return stored.existing_report_ids(
        all_reports(spark, sf), "Credit Rating", "1998-01-15 10:00:00"
    )


def recheck_scan(spark, sf):
    rows = stored.recheck_scan(clean(spark, sf), fx.AS_OF, 400, requests.HISTORY_MIN)
    return rows.select("news_id", "company", "category", "Tradedate")


def semi_by_ids(spark, sf):
    return stored.stored_rows_of(_duplicated_keys(spark, sf), fx.urgent_ids(spark, sf))


def flatten_json(spark, sf):
    props = T.StructType([T.StructField("k", T.LongType())])
    nested = fx.table(spark, sf, "events").select(
        "event_id",
        F.struct(
            F.col("event_type").alias("kind"), F.from_json("props", props).alias("props")
        ).alias("detail"),
    )
    return shape.flatten(nested)


def flatten_props(spark, sf):
    """The properties of events, whose fields no schema names."""
    events = fx.table(spark, sf, "events").select("event_id", "props")
    return flatten_discovered(events, "props").drop("props")


def flatten_mixed(spark, sf):
    """Records whose fields differ, with lists and values of several kinds."""
    found = flatten_discovered(fx.nested_records(spark, sf)).drop("record")
    return found.withColumn("tags", F.array_join("tags", "|"))


# --- sinks ------------------------------------------------------------------------------------


def append_new_only_query(spark, sf):
    """Two appends of overlapping runs, then the table."""
    path = new_folder(spark, "announcements")
    columns = ["news_id", "SCRIP_CD", "ingest_seq"]
    every = ann.with_attachment(fx.announcements(spark, sf))
    for run in (every.where("o_orderstatus = 'F'"), every):
        append_new_only(run.select(*columns), path, ["news_id"], ["ingest_seq"])
    return spark.read.parquet(path)


def insert_metrics(spark, sf):
    batch = ann.with_attachment(fx.announcements(spark, sf))
    return counts.insert_metrics(batch, fx.stored_ids(spark, sf))


def jsonl_archive(spark, sf):
    """Two archive runs that overlap, then the lines."""
    path = new_folder(spark, "archive")
    every = ann.with_attachment(fx.announcements(spark, sf))
    archive_jsonl(every.where("o_orderstatus = 'F'"), path, "run-1", "filter", "hist")
    archive_jsonl(every, path, "run-2", "filter", "hist")
    lines = spark.read.schema("ingest_seq bigint, news_id string, HeadLine string").json(
        f"{path}/records"
    )
    return lines.select("ingest_seq", "news_id", "HeadLine")


# --- filters and text -------------------------------------------------------------------------


def pdf_filter(spark, sf):
    return ann.with_attachment(fx.announcements(spark, sf)).select(
        "ingest_seq", "AttachmentName", "news_id"
    )


def url_suffix(spark, sf):
    """The suffix filter and the part split on page addresses."""
    pages = fx.table(spark, sf, "pages").select("page_id", "url")
    return ann.with_attachment(pages, "url", "#top", "address").select(
        "page_id", "address", without_last_part(F.col("address"), "/").alias("parent")
    )


def known_company(spark, sf):
    rows = ann.known_company(
        fx.announcements(spark, sf), master.company_master(fx.companies(spark, sf))
    )
    return rows.select("ingest_seq", "SCRIP_CD")


def drop_bad_dates(spark, sf):
    return ann.with_trade_date(fx.announcements(spark, sf)).select("ingest_seq", "Tradedate")


def report_candidates(spark, sf):
    return reports.report_candidates(clean(spark, sf)).select("news_id", "category")


def trim_all_strings(spark, sf):
    return strip_strings(fx.announcements(spark, sf))


def trim_documents(spark, sf):
    return strip_strings(fx.table(spark, sf, "documents"), ["text"]).select("doc_id", "text")


def parse_tradedate(spark, sf):
    rows = fx.announcements(spark, sf)
    return rows.select(
        "ingest_seq", render(parse_trade_date(F.col("Tradedate"))).alias("trade_ts")
    )


def parse_multi_format(spark, sf):
    rows = fx.date_texts(spark, sf)
    return rows.select(
        "event_id", "spelled", render(parse_any_date(F.col("spelled"))).alias("parsed")
    )


def datecode_query(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", datecode(F.col("ts")).alias("datecode"))


def fiscal_calendar(spark, sf):
    dt = F.col("o_orderdate")
    return fx.table(spark, sf, "orders").select(
        "o_orderkey",
        big(F.month(dt)).alias("cal_month"),
        big(F.year(dt)).alias("cal_year"),
        fiscal_quarter(dt).alias("fin_qtr"),
        fiscal_year(dt).alias("fin_year"),
    )


def bucketize_query(spark, sf):
    bounds, labels = [0, 1000, 50000, 150000, 300000], ["tiny", "small", "middle", "large"]
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", bucketize(F.col("o_totalprice"), bounds, labels).alias("bucket")
    )


# --- master and joins -------------------------------------------------------------------------


def company_master(spark, sf):
    return flat_symbols(master.company_master(fx.companies(spark, sf)))


def master_last_wins(spark, sf):
    return flat_symbols(master.company_master(fx.relisted_companies(spark, sf)))


def enrich_company(spark, sf):
    rows = ann.enrich_company(
        fx.announcements(spark, sf), master.company_master(fx.companies(spark, sf))
    )
    return flat_symbols(rows).select(
        "ingest_seq", "SCRIP_CD", "company", "nse", "bse", "company_name", "selected"
    )


def new_announcements(spark, sf):
    rows = ann.with_attachment(fx.announcements(spark, sf))
    return keys.without_keys(rows, fx.stored_ids(spark, sf), "news_id").select(
        "ingest_seq", "news_id"
    )


def new_announcements_narrow(spark, sf):
    rows = ann.with_attachment(fx.announcements(spark, sf))
    return keys.without_keys(
        rows, fx.stored_ids(spark, sf), "news_id", narrow_first=True
    ).select("ingest_seq", "news_id")


def new_reports(spark, sf):
    candidates = reports.report_candidates(clean(spark, sf))
    return reports.new_reports(candidates, earlier_reports(spark, sf)).select("news_id", "category")


def ids_difference(spark, sf):
    ids = ann.with_attachment(fx.announcements(spark, sf))
    return keys.ids_difference(ids, fx.stored_ids(spark, sf), "news_id")


# --- first rows and duplicates ----------------------------------------------------------------


def dedup_first(spark, sf):
    return keys.keep_first(
        ann.with_attachment(fx.announcements(spark, sf)), "news_id", ["ingest_seq"]
    ).select("ingest_seq", "news_id", "SCRIP_CD")


def dedup_documents(spark, sf):
    """First document of each whole text."""
    rows = keys.first_of_each_text(fx.table(spark, sf, "documents"), "text", ["doc_id"])
    return rows.select("doc_id", "lang", "source", "n_chars")


def duplicate_groups(spark, sf):
    return keys.duplicate_groups(_duplicated_keys(spark, sf))


def duplicates_to_delete(spark, sf):
    return keys.surplus_rows(_duplicated_keys(spark, sf)).select("row_id", "news_id", "report_id")


def duplicates_kept(spark, sf):
    return keys.without_surplus(_duplicated_keys(spark, sf)).select("row_id", "news_id", "report_id")


def duplicates_of_listed_ids(spark, sf):
    """Only the listed keys are cleared: those of the customers' building orders."""
    customers = fx.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    listed = (
        fx.table(spark, sf, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
        .select(F.col("o_orderkey").cast("string").alias("news_id"))
    )
    rows = _duplicated_keys(spark, sf).select("row_id", "news_id")
    return keys.without_surplus(rows, listed)


def remove_duplicates_query(spark, sf):
    """Store the reports and their copies, clear the table in place, read it."""
    path = new_folder(spark, "reports")
    schema = T.StructType(
        REPORTS.fields[:-1] + [T.StructField("row_id", T.LongType()), REPORTS.fields[-1]]
    )
    rows = _duplicated(spark, sf).withColumn(
        "batch", F.when(F.col("row_id") % 2 == 0, "first").otherwise("copies")
    )
    parts = [*Store.REPORT_PARTITIONS, "batch"]
    rows.write.partitionBy(*parts).parquet(path)
    remove_duplicates(spark, path, schema, parts, order_by=["row_id"])
    return stored.read_table(spark, path, schema).select("row_id", "news_id", "report_id")


# --- categories and reports -------------------------------------------------------------------


def categorise(spark, sf):
    return ann.categorise(fx.announcements(spark, sf)).select("ingest_seq", "category")


def categorise_documents(spark, sf):
    """A rule list over whole document texts, with a body rule on the source."""
    rows = ann.categorise(
        fx.table(spark, sf, "documents"),
        TEXT_RULES,
        descriptor="lang",
        headline="text",
        body="source",
        default="Other",
    )
    return rows.select("doc_id", "category")


def word_rules(spark, sf):
    """A rule per longer word of ``benchmark``, the longest first, between rules that are patterns."""
    words = fx.table(spark, sf, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), F.lit(0))).alias("headline")
    )
    place = F.row_number().over(Window.orderBy(F.length("headline").desc(), "headline"))
    plain = words.distinct().select(
        (place + 10).cast("bigint").alias("precedence"),
        F.concat(F.lit("word "), "headline").alias("category"),
        "headline",
        F.lit(None).cast("string").alias("body"),
    )
    listed = [(0 if i < 2 else 10**9, *rule) for i, rule in enumerate(TEXT_RULES)]
    return plain.unionByName(
        spark.createDataFrame(listed, "precedence bigint, category string, headline string, body string")
    )


def categorise_by_rule_table(spark, sf):
    """Hundreds of rules, read from a table, over whole document texts."""
    rows = categorise_by_table(
        fx.table(spark, sf, "documents"),
        word_rules(spark, sf),
        descriptor="lang",
        headline="text",
        body="source",
        default="Other",
    )
    return rows.select("doc_id", "category")


def category_counts(spark, sf):
    return counts.counts_by(clean(spark, sf), "category")


def clean_announcements(spark, sf):
    rows = clean(spark, sf, stored_ids=fx.stored_ids(spark, sf))
    return flat_symbols(rows).select(
        "ingest_seq", "news_id", "SCRIP_CD", "company", "selected", "Tradedate",
        "Descriptor", "HeadLine", "NewsBody", "category",
    )


def clean_after_parse(spark, sf):
    """The other order of steps, with the case of the texts kept."""
    rows = clean(
        spark, sf, stored_ids=fx.stored_ids(spark, sf), dedup="after_parse", preserve_case=True
    )
    return rows.select(
        "ingest_seq", "news_id", "Tradedate", "Descriptor", "HeadLine", "NewsBody", "category"
    )


def base_report_id(spark, sf):
    rows = reports.with_base_report_id(reports.report_candidates(clean(spark, sf)))
    return rows.select(
        "news_id", report_code(F.col("category")).alias("code"), "base_report_id"
    )


def report_id_prefix(spark, sf):
    return all_reports(spark, sf).select(
        "report_id", without_last_part(F.col("report_id")).alias("prefix")
    )


def existing_counts(spark, sf):
    return reports.existing_counts(all_reports(spark, sf))


def existing_counts_since(spark, sf):
    return reports.existing_counts(all_reports(spark, sf), "1998-02-15 00:00:00")


def nation_filings(spark, sf):
    """Orders grouped by nation and financial quarter: few, large groups."""
    dt = F.col("o_orderdate")
    nation = fx.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    base = F.concat(
        F.lit("N"), F.col("c_nationkey").cast("string"), F.lit("_FY"),
        F.year(dt).cast("string"), fiscal_quarter(dt),
    )
    return (
        fx.table(spark, sf, "orders")
        .join(nation, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderstatus", "o_orderdate", base.alias("base_id"))
    )


def report_numbering(spark, sf):
    rows = nation_filings(spark, sf)
    taken = counts.counts_by(rows.where("o_orderstatus = 'F'"), "base_id")
    numbered = numbering.number_within(
        rows.where("o_orderstatus <> 'F'"),
        "base_id",
        ["o_orderdate", "o_orderkey"],
        taken,
    )
    return numbered.select("o_orderkey", "base_id", "count")


def report_numbering_spread(spark, sf):
    """Five groups, each a fifth of all orders; groups above 1000 rows are spread over tasks."""
    rows = fx.table(spark, sf, "orders")
    return numbering.number_within(
        rows, "o_orderpriority", ["o_orderdate", "o_orderkey"], max_group_rows=1000
    ).select("o_orderkey", "o_orderpriority", "count")


def report_numbering_spread_started(spark, sf):
    """The same for the unfinished orders, after the numbers the finished ones have taken."""
    rows = fx.table(spark, sf, "orders")
    taken = counts.counts_by(rows.where("o_orderstatus = 'F'"), "o_orderpriority")
    return numbering.number_within(
        rows.where("o_orderstatus <> 'F'"),
        "o_orderpriority",
        ["o_orderdate", "o_orderkey"],
        taken,
        max_group_rows=100,
    ).select("o_orderkey", "o_orderpriority", "count")


def compact_store(spark, sf):
    """Two batches of all years merged into one."""
    store = _batches(spark, sf, "compact")
    compact(spark, store, "merged", ["run-1", "run-2"])
    return store.reports(spark).select("news_id", "report_id", "report_type", "count")


def reports_full(spark, sf):
    """Flagship: all announcements to numbered reports, nothing stored before."""
    rows = staged(clean(spark, sf), "announcements")
    return report_columns(
        reports.build_reports(rows, stored.empty_table(spark, REPORTS), fx.AS_OF)
    )


def reports_continued(spark, sf):
    """A later run: stored ids and stored reports from the earlier one."""
    rows = staged(clean(spark, sf, stored_ids=fx.stored_ids(spark, sf)), "announcements")
    return report_columns(reports.build_reports(rows, earlier_reports(spark, sf), fx.AS_OF))


def _batches(spark, sf, name, keep_counts=False):
    """The earlier run and the full run as two stored batches."""
    store = Store(new_folder(spark, name), period="year", keep_counts=keep_counts)
    companies = master.company_master(fx.companies(spark, sf))
    raw = fx.announcements(spark, sf)
    for batch, rows in (("run-1", raw.where("o_orderstatus = 'F'")), ("run-2", raw)):
        run_batch(rows, companies, store, batch, as_of=fx.AS_OF)
    return store


def maintained_counts(spark, sf):
    """Kept counts number the second batch, and hold after a rerun of the first and a compaction."""
    store = _batches(spark, sf, "counts", keep_counts=True)
    raw = fx.announcements(spark, sf).where("o_orderstatus = 'F'")
    run_batch(raw, master.company_master(fx.companies(spark, sf)), store, "run-1", as_of=fx.AS_OF)
    compact(spark, store, "merged", ["run-1", "run-2"])
    return store.report_counts(spark)


def ingest_batches(spark, sf):
    store = _batches(spark, sf, "ingest")
    return store.reports(spark).select("news_id", "report_id", "report_type", "count", "batch")


def recheck_reports(spark, sf):
    """The second run stops between its two writes; the recheck adds the reports that lack."""
    store = Store(new_folder(spark, "recheck"), period="year")
    companies = master.company_master(fx.companies(spark, sf))
    raw = fx.announcements(spark, sf)
    run_batch(raw.where("o_orderstatus = 'F'"), companies, store, "run-1", as_of=fx.AS_OF)
    known = stored.existing_news_ids(store.announcements(spark))
    store_announcements(ann.clean_announcements(raw, companies, known), store, "run-2")
    recheck(spark, store, "recheck", fx.AS_OF, days=400)
    return (
        store.reports(spark).where("batch = 'recheck'").select("news_id", "report_id", "count")
    )


def stored_announcements(spark, sf):
    """Land, ingest and read back, with a field that no schema names."""
    path = new_folder(spark, "stored")
    raw = fx.announcements(spark, sf).withColumnRenamed("ingest_seq", "order_seq")
    raw.write.json(f"{path}/landed")
    store = Store(f"{path}/store", period="year")
    companies = master.company_master(fx.companies(spark, sf))
    rows = landed.read_announcements(spark, f"{path}/landed", extra=ORDER_SEQ)
    run_batch(rows, companies, store, "run", as_of=fx.AS_OF, order_by=["order_seq"])
    status = F.get_json_object("record", "$.o_orderstatus").alias("status")
    return flat_symbols(store.announcements(spark)).select(
        "news_id", "SCRIP_CD", "company", "selected", "Tradedate", "HeadLine", "category", status
    )


def run_metrics_query(spark, sf):
    companies = master.company_master(fx.companies(spark, sf))
    return counts.run_metrics(fx.announcements(spark, sf), companies, fx.stored_ids(spark, sf))


def archived_run(spark, sf):
    """A run that archives its raw and its stored rows."""
    path = new_folder(spark, "archived")
    companies = master.company_master(fx.companies(spark, sf))
    store = Store(f"{path}/store", period="year")
    raw = fx.announcements(spark, sf)
    run_batch(raw, companies, store, "run", as_of=fx.AS_OF, archive=f"{path}/archive")
    lines = spark.read.schema("news_id string, data_type string").json(f"{path}/archive/records")
    return lines.select("news_id", "data_type")


def batch_rerun(spark, sf):
    """One batch with all orders, run again with the finished ones; another, run again with none."""
    store = Store(new_folder(spark, "rerun"), period="year")
    companies = master.company_master(fx.companies(spark, sf))
    raw = fx.announcements(spark, sf)
    for batch, rows in (
        ("gone", raw),
        ("gone", raw.where(F.lit(False))),
        ("run", raw),
        ("run", raw.where("o_orderstatus = 'F'")),
    ):
        run_batch(rows, companies, store, batch, as_of=fx.AS_OF)
    return store.announcements(spark).select("news_id", "company", "category", "Tradedate", "batch")


def rerun_after_later_batch(spark, sf):
    """The first of two batches runs once more: every report keeps its id."""
    store = _batches(spark, sf, "rerun")
    companies = master.company_master(fx.companies(spark, sf))
    raw = fx.announcements(spark, sf).where("o_orderstatus = 'F'")
    run_batch(raw, companies, store, "run-1", as_of=fx.AS_OF)
    return store.reports(spark).select("news_id", "report_id", "report_type", "count", "batch")


def numbers_after_removal(spark, sf):
    """Every other stored report is gone; new ones are numbered after the highest that is left."""
    rows = staged(clean(spark, sf, stored_ids=fx.stored_ids(spark, sf)), "announcements")
    left = earlier_reports(spark, sf).where(F.col("count") % 2 == 0)
    built = reports.build_reports(rows, left, fx.AS_OF)
    return built.select("news_id", "report_id", "count", "report_type")


def recheck_all_history(spark, sf):
    """A recheck without a number of days, over announcements of all years."""
    store = Store(new_folder(spark, "recheck"), period="year")
    companies = master.company_master(fx.companies(spark, sf))
    raw = fx.announcements(spark, sf)
    run_batch(raw.where("o_orderstatus = 'F'"), companies, store, "run-1", as_of=fx.AS_OF)
    known = stored.existing_news_ids(store.announcements(spark))
    store_announcements(ann.clean_announcements(raw, companies, known), store, "run-2")
    recheck(spark, store, "recheck", fx.AS_OF, days=None)
    return (
        store.reports(spark).where("batch = 'recheck'").select("news_id", "report_id", "count")
    )


def _streamed(spark, sf) -> Store:
    """Orders landed in three parts, each with repeats of the one before; the stream restarts between."""
    path = new_folder(spark, "stream")
    raw = fx.announcements(spark, sf).withColumnRenamed("ingest_seq", "order_seq")
    most = raw.agg(F.max("order_seq")).first()[0] or 0
    part = F.floor(F.col("order_seq") * 3 / F.lit(most + 1))
    store = Store(f"{path}/store", ORDER_SEQ, period="year")
    for number in range(3):
        again = (part == number - 1) & (F.col("order_seq") % 10 == 0)
        raw.where((part == number) | again).write.mode("append").json(f"{path}/landed")
        run_stream(
            landed.stream_announcements(spark, f"{path}/landed", extra=ORDER_SEQ),
            lambda: master.company_master(fx.companies(spark, sf)),
            store,
            f"{path}/checkpoint",
            available_now=True,
            live_days=fx.STREAM_DAYS,
            now=lambda: datetime.fromisoformat(fx.AS_OF),
            order_by=["order_seq"],
        ).awaitTermination()
    return store


def stream_batches(spark, sf):
    """Stored announcements and their reports after three micro-batches with a live window."""
    store = _streamed(spark, sf)
    made = store.reports(spark).select("news_id", "report_id", "report_type", "count")
    told = store.announcements(spark).select("news_id", "company", "category", "Tradedate")
    return told.join(made, "news_id", "left")


def stream_late(spark, sf):
    """Rows that were too old for that window."""
    store = _streamed(spark, sf)
    return spark.read.parquet(store.late_path).select("order_seq").distinct()


def stream_event_time(spark, sf):
    """Three parts with repeats; late is what lies far behind the latest trade of the parts before."""
    path = new_folder(spark, "stream")
    raw = fx.announcements(spark, sf).withColumnRenamed("ingest_seq", "order_seq")
    store = Store(f"{path}/store", ORDER_SEQ, period="year")
    for number in range(3):
        again = (F.col("order_seq") % 30 == 0) & F.lit(number > 0)
        raw.where((F.col("order_seq") % 3 == number) | again).write.mode("append").json(f"{path}/landed")
        run_stream(
            landed.stream_announcements(spark, f"{path}/landed", extra=ORDER_SEQ),
            lambda: master.company_master(fx.companies(spark, sf)),
            store,
            f"{path}/checkpoint",
            available_now=True,
            late_after=timedelta(days=fx.LATE_DAYS),
            dedup_delay="5 days",
            now=lambda: datetime.fromisoformat(fx.AS_OF),
            order_by=["order_seq"],
        ).awaitTermination()
    kept = store.announcements(spark).select("order_seq", F.lit("stored").alias("kind"))
    return kept.unionByName(spark.read.parquet(store.late_path).select("order_seq", F.lit("late").alias("kind")))


def stream_ingest(spark, sf):
    """All announcements landed as files and ingested by the stream, then the stored reports."""
    path = new_folder(spark, "stream")
    raw = fx.announcements(spark, sf)
    raw.withColumnRenamed("ingest_seq", "order_seq").write.json(f"{path}/landed")
    store = Store(f"{path}/store", ORDER_SEQ, period="year")
    stream = landed.stream_announcements(spark, f"{path}/landed", extra=ORDER_SEQ)
    run_stream(
        stream,
        lambda: master.company_master(fx.companies(spark, sf)),
        store,
        f"{path}/checkpoint",
        available_now=True,
        live_days=None,
        order_by=["order_seq"],
    ).awaitTermination()
    return store.reports(spark).select("news_id", "report_id", "report_type", "count", "dt_tm")


QUERIES = {
    "src_announcements": src_announcements,
    "response_triage": response_triage,
    "response_records": response_records,
    "per_day_counts": per_day_counts,
    "date_spine_hist": date_spine_hist,
    "range_clamp": range_clamp,
    "date_spine_live": date_spine_live,
    "date_spine_live_literal": date_spine_live_literal,
    "request_plan": request_plan,
    "backfill_gaps": backfill_gaps,
    "src_big_arrays": src_big_arrays,
    "retry_plan": retry_plan_query,
    "cursor_log": cursor_log_query,
    "union_days": union_days,
    "company_master": company_master,
    "master_last_wins": master_last_wins,
    "existing_news_ids": existing_news_ids,
    "existing_report_ids": existing_report_ids,
    "recheck_scan": recheck_scan,
    "semi_by_ids": semi_by_ids,
    "flatten_json": flatten_json,
    "flatten_props": flatten_props,
    "flatten_mixed": flatten_mixed,
    "append_new_only": append_new_only_query,
    "insert_metrics": insert_metrics,
    "jsonl_archive": jsonl_archive,
    "pdf_filter": pdf_filter,
    "url_suffix": url_suffix,
    "known_company": known_company,
    "drop_bad_dates": drop_bad_dates,
    "report_candidates": report_candidates,
    "trim_all_strings": trim_all_strings,
    "trim_documents": trim_documents,
    "parse_tradedate": parse_tradedate,
    "parse_multi_format": parse_multi_format,
    "datecode": datecode_query,
    "fiscal_calendar": fiscal_calendar,
    "bucketize": bucketize_query,
    "enrich_company": enrich_company,
    "new_announcements": new_announcements,
    "new_announcements_narrow": new_announcements_narrow,
    "new_reports": new_reports,
    "ids_difference": ids_difference,
    "dedup_first": dedup_first,
    "dedup_documents": dedup_documents,
    "duplicate_groups": duplicate_groups,
    "duplicates_to_delete": duplicates_to_delete,
    "duplicates_kept": duplicates_kept,
    "duplicates_of_listed_ids": duplicates_of_listed_ids,
    "remove_duplicates": remove_duplicates_query,
    "categorise": categorise,
    "categorise_documents": categorise_documents,
    "categorise_by_rule_table": categorise_by_rule_table,
    "category_counts": category_counts,
    "clean_announcements": clean_announcements,
    "clean_after_parse": clean_after_parse,
    "base_report_id": base_report_id,
    "report_id_prefix": report_id_prefix,
    "existing_counts": existing_counts,
    "existing_counts_since": existing_counts_since,
    "report_numbering": report_numbering,
    "report_numbering_spread": report_numbering_spread,
    "reports_full": reports_full,
    "reports_continued": reports_continued,
    "ingest_batches": ingest_batches,
    "maintained_counts": maintained_counts,
    "recheck_reports": recheck_reports,
    "stream_ingest": stream_ingest,
    "batch_rerun": batch_rerun,
    "report_numbering_spread_started": report_numbering_spread_started,
    "compact_store": compact_store,
    "src_array_layout": src_array_layout,
    "src_rejects": src_rejects,
    "response_rejects": response_rejects,
    "response_mixed": response_mixed,
    "stored_announcements": stored_announcements,
    "run_metrics": run_metrics_query,
    "archived_run": archived_run,
    "rerun_after_later_batch": rerun_after_later_batch,
    "numbers_after_removal": numbers_after_removal,
    "recheck_all_history": recheck_all_history,
    "stream_batches": stream_batches,
    "stream_late": stream_late,
    "stream_event_time": stream_event_time,
}
