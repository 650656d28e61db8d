from datetime import date

from filingloom.operators.reports import taken_numbers
from filingloom.plans.compact import compact
from filingloom.plans.duplicates import remove_duplicates
from filingloom.plans.ingest import Store
from filingloom.plans.report_counts import refresh_counts
from filingloom.schemas import REPORTS
from filingloom.sinks.tables import write_batch
from pyspark.sql import functions as F


def written(spark, store, batch, ids):
    """One batch of reports: (base id, number, quarter)."""
    rows = spark.createDataFrame(
        [(f"{base}_{n}", f"{base}{n}", day, "Annual Report") for base, n, day in ids],
        "report_id string, news_id string, quarter_start date, report_type string",
    )
    columns = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in REPORTS.fields
        if f.name != "batch"
    ]
    write_batch(rows.select(columns), store.reports_path, batch, Store.REPORT_PARTITIONS)


def equal(spark, store, quarters=None):
    def pairs(df):
        return sorted((r["base_report_id"], r["n"]) for r in df.collect())

    expected = pairs(taken_numbers(store.reports(spark, quarters)))
    assert pairs(store.report_counts(spark, quarters)) == expected
    return dict(expected)


def test_counts_follow_the_reports(spark, tmp_path):
    store = Store(str(tmp_path), keep_counts=True)
    assert equal(spark, store) == {}
    first, second = date(2024, 1, 1), date(2024, 4, 1)
    written(spark, store, "a", [("x", 1, first), ("x", 2, first), ("y", 1, second)])
    assert equal(spark, store) == {"x": 2, "y": 1}
    before = refresh_counts(spark, store.reports_path, store.counts_path)
    written(spark, store, "b", [("x", 3, first), ("x", 7, first)])
    assert equal(spark, store) == {"x": 7, "y": 1}
    after = refresh_counts(spark, store.reports_path, store.counts_path)
    assert set(before) < set(after)  # Counts of other folders were not made again.
    assert equal(spark, store, [second]) == {"y": 1}
    written(spark, store, "a", [("x", 1, first)])
    assert equal(spark, store) == {"x": 7}
    written(spark, store, "b", [("x", 2, first), ("x", 3, first)])
    compact(spark, store, "all", ["a", "b"])
    assert equal(spark, store) == {"x": 3}
    extra = store.reports(spark).where("report_id = 'x_2'").drop("batch")
    write_batch(extra, store.reports_path, "copy", Store.REPORT_PARTITIONS)
    remove_duplicates(
        spark, store.reports_path, REPORTS, (*Store.REPORT_PARTITIONS, "batch"), order_by=("report_id",)
    )
    assert equal(spark, store) == {"x": 3}
