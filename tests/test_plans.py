"""Shapes of the physical plans, so that a change that costs a shuffle is seen."""

import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from filingloom.checks import fixtures as fx
from filingloom.checks import queries as q
from filingloom.operators import announcements as ann
from filingloom.operators import keys, numbering, reports
from filingloom.operators.master import company_master
from filingloom.sinks.tables import write_batch
from filingloom.sinks.workspace import staged

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    """Plan as for tables too big to broadcast."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"\bExchange (?:hash|range|single)", text))


def test_cleaning_shares_its_shuffle_with_the_exclusion(spark, no_broadcast):
    """Raw rows move for the company join and once for first rows and stored ids together."""
    text = plan(q.clean(spark, SF, stored_ids=fx.stored_ids(spark, SF)))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # raw by code; master for the last row per code and for the join; raw and stored by news id
    assert shuffles(text) == 5
    assert text.count("WindowGroupLimit") == 4


def test_small_master_is_broadcast(spark):
    text = plan(q.clean(spark, SF, stored_ids=fx.stored_ids(spark, SF)))
    assert text.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in text


def test_numbering_shares_its_shuffle_with_the_counts(spark, no_broadcast):
    rows = staged(q.clean(spark, SF), "announcements")
    stored = q.earlier_reports(spark, SF)
    candidates = reports.with_base_report_id(reports.report_candidates(rows))
    text = plan(reports.number_reports(candidates, reports.existing_counts(stored)))
    # candidates by base id; stored ids by id, then by base id
    assert shuffles(text) == 3


def test_first_row_is_limited_before_the_shuffle(spark):
    text = plan(keys.keep_first(fx.table(spark, SF, "documents"), "text", ["doc_id"]))
    before_shuffle = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


@pytest.fixture
def eager_split(spark, no_broadcast):
    """Let adaptive execution split partitions as small as those of a test."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def crowded(spark):
    """Two thirds of the filings are of one company, which files everything under one id."""
    row = F.col("id")
    hot = row % 3 < 2
    return spark.range(0, 60_000, 1, 8).select(
        F.sha2(row.cast("string"), 256).alias("AttachmentName"),
        F.when(hot, 500001).otherwise(500000 + row % 97).cast("string").alias("SCRIP_CD"),
        F.when(hot, "hot").otherwise((row % 20_011).cast("string")).alias("news_id"),
        row.alias("row_id"),
    )


def was_split(df):
    return "SortMergeJoin(skew=true)" in plan(df)


def test_crowded_company_is_split(spark, eager_split, crowded):
    master = company_master(fx.companies(spark, SF))
    codes = {r.SCRIP_CD for r in master.collect()}
    expected = sum(r.SCRIP_CD in codes for r in crowded.collect())
    enriched = ann.enrich_company(crowded, master)
    known = ann.known_company(crowded, master)
    for out in (enriched, known):
        assert len(out.collect()) == expected
        assert was_split(out)


def test_crowded_key_is_split(spark, eager_split, crowded):
    rows = crowded.collect()
    stored = crowded.where("row_id % 3 = 2 and row_id < 20000").select("news_id")
    known = {r.news_id for r in stored.collect()}
    fresh = keys.without_keys(crowded, stored, "news_id")
    assert len(fresh.collect()) == sum(r.news_id not in known for r in rows)
    assert was_split(fresh)

    listed = keys.only_keys(crowded, stored.unionAll(crowded.select("news_id")), "news_id")
    assert len(listed.collect()) == len(rows)
    assert was_split(listed)

    surplus = keys.surplus_rows(crowded)
    assert len(surplus.collect()) == len(rows) - len({r.news_id for r in rows})
    assert was_split(surplus)


def test_scans_are_pruned_and_filtered(spark):
    text = plan(company_master(fx.table(spark, SF, "customer").selectExpr(
        "cast(c_custkey as string) bsecode", "c_name nsesymbol", "c_name companyname",
        "c_name isin", "c_acctbal mcap", "c_custkey load_seq",
    )))
    assert "GreaterThan(c_acctbal,0.0)" in text
    assert "c_mktsegment" not in text and "c_nationkey" not in text


def test_no_python_in_any_plan(spark):
    for name in ("clean_announcements", "categorise_documents", "response_records", "range_clamp"):
        text = plan(q.QUERIES[name](spark, SF))
        assert "Python" not in text and "Pandas" not in text


def test_a_rerun_moves_its_candidates_as_often_as_a_first_run(spark, no_broadcast):
    """Numbers made before are looked up in the layout in which reported candidates are left out (F4, F6)."""
    rows = staged(q.clean(spark, SF), "announcements")
    stored = q.earlier_reports(spark, SF)
    own = stored.where("count = 1").withColumn("batch", F.lit("b"))

    def scans(**options):
        text = plan(reports.build_reports(rows, stored.where("count > 1"), fx.AS_OF, **options))
        return len(re.findall(r"FileScan parquet .*announcements-", text))

    assert scans(own=own) == scans() == 1


def test_copies_are_cleared_without_their_texts(spark):
    """The stored state of the duplicate queries holds keys alone, the same ones as the whole reports (F5)."""
    whole, held = q._duplicated(spark, SF), q._duplicated_keys(spark, SF)
    assert set(held.columns) == {"row_id", "news_id", "report_id"}
    assert held.count() and sorted(held.collect()) == sorted(whole.select(held.columns).collect())
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(q.duplicates_of_listed_ids(spark, SF)))
    assert not any("symbolmap" in columns or "report_line" in columns for columns in read)


def test_numbering_sorts_its_candidates_once(spark, no_broadcast):
    """Numbered by a window that comes before the join with the counts, with and without given numbers (F6)."""
    rows = spark.createDataFrame([("g", 1, None), ("g", 2, 7)], "g string, id int, had bigint")
    start = spark.createDataFrame([("g", 7)], "g string, n long")
    for given in (None, "had"):
        out = numbering.number_within(rows, "g", ["id"], start, rows_at_most=2, given=given)
        text = plan(out)
        assert len(re.findall(r"\bSort \[", text)) == 2 and shuffles(text) == 2


def test_texts_are_stripped_and_dates_parsed_once(spark, no_broadcast):
    """Spark's own tests for NULL repeat no parsing and no stripping of the company code (F6)."""
    raw = spark.createDataFrame([("a.pdf", "1", "x")], "AttachmentName string, SCRIP_CD string, Tradedate string")
    assert plan(ann.with_trade_date(raw)).count("regexp_replace(") == 1
    master = spark.createDataFrame([("1", "C")], "SCRIP_CD string, company string")
    assert "isnotnull(trim(" not in re.sub(r"CASE WHEN .*? THEN ", "", plan(ann.enrich_company(raw, master)))


def test_a_large_batch_is_bounded_by_lots_of_companies(spark, monkeypatch):
    """Base ids are counted only where a lot of companies has too many rows (F6)."""
    rows = [(f"c{i % 50}", f"c{i % 50}_{i // 50}") for i in range(500)] + [(None, None)] * 9
    based = spark.createDataFrame(rows, "company string, base_report_id string")
    assert 10 <= reports._largest_group(based, 100) <= 100
    assert reports._largest_group(based, 5) == 1
    monkeypatch.setattr(reports, "COMPANY_BUCKETS", 1)
    assert reports._largest_group(based, 600) == 500


def test_various_columns_have_no_dictionary(spark, tmp_path):
    """Columns of hardly repeating values are written without a try at dictionaries (F6)."""
    df = spark.range(500).selectExpr("'p' part", "cast(id % 9 as string) few", "cast(id as string) many")
    write_batch(df.coalesce(1), str(tmp_path), "b", ["part"], various=["many"])
    (file,) = tmp_path.glob("part=p/batch=b/part-*.parquet")
    group = pq.ParquetFile(file).metadata.row_group(0)
    found = {group.column(i).path_in_schema: group.column(i).has_dictionary_page for i in range(group.num_columns)}
    assert found == {"few": True, "many": False}
