"""Sinks, batches, recheck and duplicate removal on stored tables."""

import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from filingloom.checks import fixtures as fx
from filingloom.operators.master import company_master
from filingloom.plans import compact as compacting, duplicates, ingest
from filingloom.plans.compact import compact
from filingloom.plans.duplicates import remove_duplicates
from filingloom.plans.ingest import Store, run_batch
from filingloom.plans.recheck import recheck
from filingloom.schemas import COMPANY_MASTER, REPORTS
from filingloom.sinks import tables
from filingloom.sinks.archive import archive_jsonl
from filingloom.sinks.tables import append_new_only, write_batch
from filingloom.sinks.workspace import staged
from filingloom.sources.stored import read_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    raw = fx.announcements(spark, SF).cache()
    master = company_master(fx.companies(spark, SF)).cache()
    yield raw, master
    raw.unpersist()
    master.unpersist()


def reports_of(store, spark):
    rows = store.reports(spark).collect()
    return {r.news_id: (r.report_id, r["count"], r.batch) for r in rows}


def rows_of(path):
    return sorted(str(p) for p in path.rglob("*.parquet"))


# --- sinks ------------------------------------------------------------------------------------


def test_append_new_only_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame(
        [("a", 2), ("a", 1), ("b", 3), ("c", 4)], "news_id string, seq int"
    )
    first = append_new_only(batch, path, ["news_id"], ["seq"])
    assert first == {"total": 4, "inserted": 3, "duplicates": 1}
    again = append_new_only(batch, path, ["news_id"], ["seq"])
    assert again == {"total": 4, "inserted": 0, "duplicates": 4}
    rows = spark.read.parquet(path).collect()
    assert sorted((r.news_id, r.seq) for r in rows) == [("a", 1), ("b", 3), ("c", 4)]


def test_batch_replaces_only_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "n int, part string")
    assert write_batch(df, path, "b1", ["part"]) == 2
    assert write_batch(df, path, "b2", ["part"]) == 2
    assert write_batch(df, path, "b2", ["part"]) == 2
    rows = spark.read.parquet(path).collect()
    assert sorted((r.n, r.batch) for r in rows) == [(1, "b1"), (1, "b2"), (2, "b1"), (2, "b2")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_archive_targets(spark, tmp_path):
    path = str(tmp_path / "archive")
    schema = "ingest_seq int, news_id string, HeadLine string"
    rows = spark.createDataFrame(
        [(1, "a", "é"), (2, "a", "later"), (3, "b", None), (4, "", "x"), (5, None, "x")], schema
    )
    assert archive_jsonl(rows, path, "r1", "filter", "live") == 2
    assert archive_jsonl(rows, path, "r1", "filter", "live") == 2
    assert archive_jsonl(rows, path, "r2", "filter", "live") == 0
    assert archive_jsonl(rows, path, "r2", "filter", "hist") == 2
    assert archive_jsonl(rows, path, "r3", "what", "live") == 2
    assert archive_jsonl(rows, path, "r4", "filter", "ever") == 0
    lines = spark.read.text(f"{path}/records").where("data_type = 'filter' and fetch_type = 'live'")
    assert sorted(r.value for r in lines.collect()) == [
        '{"ingest_seq":1,"news_id":"a","HeadLine":"é"}',
        '{"ingest_seq":3,"news_id":"b","HeadLine":null}',
    ]


# --- batches ----------------------------------------------------------------------------------


def test_rerun_changes_nothing(spark, inputs, tmp_path):
    raw, master = inputs
    store = Store(str(tmp_path), period="year")
    first = run_batch(raw, master, store, "b1", as_of=fx.AS_OF)
    assert first["announcements"] > first["reports"] > 0
    before = reports_of(store, spark)
    assert run_batch(raw, master, store, "b1", as_of=fx.AS_OF) == first
    assert reports_of(store, spark) == before
    assert run_batch(raw, master, store, "b2", as_of=fx.AS_OF) == {"announcements": 0, "reports": 0}
    assert recheck(spark, store, "again", fx.AS_OF, days=None, earliest="1990-01-01") == 0
    assert reports_of(store, spark) == before


def test_announcements_do_not_depend_on_the_split(spark, inputs, tmp_path):
    raw, master = inputs
    whole = Store(str(tmp_path / "whole"), period="year")
    run_batch(raw, master, whole, "b", as_of=fx.AS_OF)
    parts = Store(str(tmp_path / "parts"), period="year")
    for number, (low, high) in enumerate([(0, 499), (500, 999), (1000, 10**9)]):
        part = raw.where(F.col("ingest_seq").between(low, high))
        run_batch(part, master, parts, f"b{number}", as_of=fx.AS_OF)
    columns = ["news_id", "company", "category", "Tradedate"]
    assert set(whole.announcements(spark).select(columns).collect()) == set(
        parts.announcements(spark).select(columns).collect()
    )
    ids = [report_id for report_id, _, _ in reports_of(parts, spark).values()]
    assert len(ids) == len(set(ids)) == len(reports_of(whole, spark))


def test_crash_between_the_two_writes(spark, inputs, tmp_path, monkeypatch):
    raw, master = inputs
    half = raw.where("o_orderstatus = 'F'")
    good = Store(str(tmp_path / "good"), period="year")
    run_batch(half, master, good, "b1", as_of=fx.AS_OF)
    run_batch(raw, master, good, "b2", as_of=fx.AS_OF)

    store = Store(str(tmp_path / "crash"), period="year")
    run_batch(half, master, store, "b1", as_of=fx.AS_OF)

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "store_reports", crash)
        with pytest.raises(RuntimeError):
            run_batch(raw, master, store, "b2", as_of=fx.AS_OF)
    assert len(reports_of(store, spark)) < len(reports_of(good, spark))
    run_batch(raw, master, store, "b2", as_of=fx.AS_OF)
    assert reports_of(store, spark) == reports_of(good, spark)


def test_window_of_stored_ids_and_pruning(spark, inputs, tmp_path):
    raw, master = inputs
    for period in ("day", "month", "quarter", "year"):
        store = Store(str(tmp_path / period), period=period)
        few = raw.where("SCRIP_CD < '500040'")
        run_batch(few, master, store, "b", as_of=fx.AS_OF)
        since = datetime(2000, 2, 10, 8)
        got = {r.news_id for r in store.announcements(spark, since).collect()}
        everything = store.announcements(spark).collect()
        assert got == {r.news_id for r in everything if r.dt >= datetime(2000, 2, 10)}
        assert 0 < len(got) < len(everything)


def test_general_only_and_extra_fields(spark, inputs, tmp_path):
    from filingloom.operators.announcements import clean_announcements
    from filingloom.plans.ingest import store_announcements
    from pyspark.sql import types as T

    raw, master = inputs
    store = Store(
        str(tmp_path), T.StructType([T.StructField("o_orderstatus", T.StringType())]), "year"
    )
    clean = clean_announcements(raw, master).drop("category")
    store_announcements(clean, store, "b")
    rows = store.announcements(spark).select("category", "o_orderstatus").distinct().collect()
    assert {r.category for r in rows} == {"General"}
    assert {r.o_orderstatus for r in rows} == {"F", "O", "P"}


# --- duplicate removal ------------------------------------------------------------------------


def stored_copies(spark, path):
    """Three batches; the third holds copies only."""
    at = datetime(2025, 1, 1)
    rows = []
    for i in range(40):
        made = str(at + timedelta(minutes=i))
        rows.append((f"n{i}", f"r{i}", made, f"b{i % 2}"))
        if i % 3 == 0:
            rows.append((f"n{i}", f"r{i}x", str(at + timedelta(days=1)), "copies"))
        if i == 5:
            rows.append((f"n{i}", f"r{i}", made, f"b{i % 2}"))
    df = spark.createDataFrame(rows, "news_id string, report_id string, document_date string, batch string")
    missing = [f for f in REPORTS.fields if f.name not in df.columns]
    full = df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    full = full.withColumns(
        {"quarter_start": F.lit("2025-01-01").cast("date"), "report_type": F.lit("Credit Rating")}
    )
    full.select(REPORTS.fieldNames()).write.partitionBy(
        "quarter_start", "report_type", "batch"
    ).parquet(path)


def test_remove_duplicates_in_place(spark, tmp_path):
    path, parts = str(tmp_path / "r"), ["quarter_start", "report_type", "batch"]
    assert remove_duplicates(spark, path, REPORTS, parts) == 0
    stored_copies(spark, path)
    ids = spark.createDataFrame([("n0",), ("n5",), ("n1",)], "news_id string")
    assert remove_duplicates(spark, path, REPORTS, parts, ids) == 2
    assert remove_duplicates(spark, path, REPORTS, parts) == 13
    rows = read_table(spark, path, REPORTS).collect()
    assert sorted(r.report_id for r in rows) == sorted(f"r{i}" for i in range(40))
    assert not list((tmp_path / "r").rglob("batch=copies"))
    files = rows_of(tmp_path / "r")
    assert remove_duplicates(spark, path, REPORTS, parts) == 0
    assert rows_of(tmp_path / "r") == files


# --- reruns -----------------------------------------------------------------------------------


def case_raw(spark, *rows):
    """Raw credit ratings of company 1: (news id, trade date)."""
    schema = "AttachmentName string, SCRIP_CD string, Tradedate string, Descriptor string, HeadLine string, NewsBody string, ingest_seq int"
    data = [(f"{n}.pdf", "1", at, None, "Credit Rating", n, i) for i, (n, at) in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def case_master(spark):
    row = ("1", "N1", "Company 1", "INE1", 1.0, 1)
    return company_master(spark.createDataFrame([row], COMPANY_MASTER))


AUG1, AUG2, NOV1 = "01/08/2025 10:00:00", "02/08/2025 10:00:00", "01/11/2025 10:00:00"


def test_rerun_replaces_all_it_wrote(spark, tmp_path):
    store, master = Store(str(tmp_path)), case_master(spark)

    def run(*rows):
        counts = run_batch(case_raw(spark, *rows), master, store, "b1", as_of=fx.AS_OF)
        stored = sorted((r.news_id, r.Tradedate) for r in store.announcements(spark).collect())
        made = {r.news_id: r.report_id for r in store.reports(spark).collect()}
        return counts["reports"], stored, made

    run(("a", AUG1), ("b", AUG2))
    assert run(("a", AUG1)) == (1, [("a", "2025-08-01 10:00:00")], {"a": "INE1_CR_FY2025Q1_1"})
    assert run(("a", AUG2))[1:] == ([("a", "2025-08-02 10:00:00")], {"a": "INE1_CR_FY2025Q1_1"})
    moved = run(("a", NOV1), ("c", AUG1))
    assert moved[1] == [("a", "2025-11-01 10:00:00"), ("c", "2025-08-01 10:00:00")]
    assert set(moved[2].values()) == {"INE1_CR_FY2025Q2_1", "INE1_CR_FY2025Q1_2"}
    assert run() == (0, [], {})


def test_numbers_stay_after_later_batches(spark, tmp_path):
    store, master = Store(str(tmp_path)), case_master(spark)
    history = case_raw(spark, *[(f"h{i}", AUG1) for i in range(5)])
    live = case_raw(spark, *[(f"l{i}", AUG2) for i in range(3)])
    run_batch(history, master, store, "history", as_of=fx.AS_OF)
    run_batch(live, master, store, "live", as_of=fx.AS_OF)
    before = reports_of(store, spark)
    assert sorted(n for _, n, _ in before.values()) == list(range(1, 9))
    run_batch(history, master, store, "history", as_of=fx.AS_OF)
    assert reports_of(store, spark) == before
    more = case_raw(spark, *[(f"h{i}", AUG1) for i in range(6)])
    run_batch(more, master, store, "history", as_of=fx.AS_OF)
    after = reports_of(store, spark)
    assert {k: after[k] for k in before} == before and after["h5"][1] == 9


def test_repeated_report_ids_are_an_error(spark, tmp_path):
    store, master = Store(str(tmp_path)), case_master(spark)
    run_batch(case_raw(spark, ("a", AUG1)), master, store, "b1", as_of=fx.AS_OF)
    rows = store.reports(spark).where("batch = 'b1'").drop("batch")
    write_batch(rows.withColumn("news_id", F.lit("x")), store.reports_path, "b2", Store.REPORT_PARTITIONS)
    with pytest.raises(ValueError, match="stored twice"):
        run_batch(case_raw(spark, ("c", AUG2)), master, store, "b3", as_of=fx.AS_OF)


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_second_writer_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch, when):
    """Another writer gives a number in the moment before, or right after, this one publishes it."""
    store, master = Store(str(tmp_path)), case_master(spark)
    run_batch(case_raw(spark, ("a", AUG1)), master, store, "b1", as_of=fx.AS_OF)
    build, publish = ingest.build_reports, ingest.write_batch

    def other_writer(rows):
        taken = rows.drop("batch").withColumn("news_id", F.lit("other"))
        publish(taken, store.reports_path, "other", Store.REPORT_PARTITIONS)

    def build_and_lose(*args, **options):
        made = staged(build(*args, **options), "made")
        if when == "before":
            other_writer(made)
        return made

    def publish_and_lose(rows, path, batch, partitions, **options):
        n = publish(rows, path, batch, partitions, **options)
        if when == "after" and path == store.reports_path:
            other_writer(rows)
        return n

    monkeypatch.setattr(ingest, "build_reports", build_and_lose)
    monkeypatch.setattr(ingest, "write_batch", publish_and_lose)
    with pytest.raises(ValueError, match="stored twice"):
        run_batch(case_raw(spark, ("c", AUG2)), master, store, "b2", as_of=fx.AS_OF)
    monkeypatch.undo()
    assert sorted(r.batch for r in store.reports(spark).collect()) == ["b1", "other"]
    run_batch(case_raw(spark, ("c", AUG2)), master, store, "b2", as_of=fx.AS_OF)
    ids = [r.report_id for r in store.reports(spark).collect()]
    assert len(ids) == len(set(ids)) == 3


def test_append_counts_what_another_writer_stored_as_duplicates(spark, tmp_path, monkeypatch):
    path, columns = str(tmp_path / "t"), "news_id string, n int"
    offered = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], columns)
    choose = tables.new_rows

    def choose_and_lose(*args):
        made = staged(choose(*args), "made")
        spark.createDataFrame([("b", 9)], columns).write.mode("append").parquet(path)
        return made

    monkeypatch.setattr(tables, "new_rows", choose_and_lose)
    counts = tables.append_new_only(offered, path, ["news_id"], ["n"])
    assert counts == {"total": 3, "inserted": 1, "duplicates": 2}
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 1), ("b", 9)]


def test_batch_names_are_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="named by"):
        write_batch(spark.range(1), str(tmp_path / "t"), "a/*", ())


def test_windows_list_their_own_folders_only(spark, tmp_path):
    store, master = Store(str(tmp_path)), case_master(spark)
    run_batch(case_raw(spark, ("a", AUG1), ("b", AUG2), ("c", NOV1)), master, store, "b1", as_of=fx.AS_OF)
    files = store.announcements(spark, "2025-08-02 00:00:00").inputFiles()
    assert len(files) == 2 and not any("2025-08-01" in f for f in files)
    quarter = next(r.quarter_start for r in store.reports(spark).where("news_id = 'c'").collect())
    files = store.reports(spark, [quarter]).inputFiles()
    assert len(files) == 1 and quarter.isoformat() in files[0]


def test_metrics_and_archive_of_a_run(spark, tmp_path):
    store, master = Store(str(tmp_path / "s")), case_master(spark)
    raw = case_raw(spark, ("a", AUG1), ("a", AUG2), ("b", "n/a"))
    counts = run_batch(
        raw, master, store, "b1", as_of=fx.AS_OF, metrics=True, archive=str(tmp_path / "archive")
    )
    assert counts == {
        "announcements": 1, "reports": 1, "offered": 3, "no_attachment": 0, "unknown_company": 0,
        "bad_date": 1, "repeated": 1, "stored_before": 0, "archived_raw": 2, "archived": 1,
    }


# --- duplicates ---------------------------------------------------------------------------------

ROWS = "news_id string, n int, part string"


@pytest.mark.parametrize("parts", [["part"], []])
def test_duplicates_go_and_all_else_stays(spark, tmp_path, parts):
    path = str(tmp_path / "t")
    rows = [("n1", 1, None), ("n1", 2, None), ("n2", 3, None), ("n3", 4, "x"), ("n3", 5, "y"), (None, 6, "y")]
    df = spark.createDataFrame(rows, ROWS)
    df.write.partitionBy(*parts).parquet(path)
    assert remove_duplicates(spark, path, df.schema, parts, order_by=["n"]) == 2
    left = sorted(r.n for r in read_table(spark, path, df.schema).collect())
    assert left == [1, 3, 4, 6]
    assert remove_duplicates(spark, path, df.schema, parts, order_by=["n"]) == 0
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_failed_removal_is_finished_later(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", i, "x") for i in range(3)] + [("b", 9, "x"), ("c", 7, "y")], ROWS)
    df.write.partitionBy("part").parquet(path)

    def lose_a_folder(*args):
        shutil.rmtree(f"{path}/part=x")
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(duplicates, "_publish", lose_a_folder)
        with pytest.raises(RuntimeError):
            remove_duplicates(spark, path, df.schema, ["part"], order_by=["n"])
    assert remove_duplicates(spark, path, df.schema, ["part"], order_by=["n"]) == 2
    assert sorted(r.n for r in read_table(spark, path, df.schema).collect()) == [0, 7, 9]


def test_default_order_takes_the_lower_number(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "news_id string, document_date string, count long, report_id string"
    df = spark.createDataFrame([("a", "d", 10, "X_10"), ("a", "d", 2, "X_2")], schema)
    df.write.parquet(path)
    remove_duplicates(spark, path, df.schema)
    assert read_table(spark, path, df.schema).first().report_id == "X_2"


def test_compaction_keeps_rows_and_makes_fewer_files(spark, inputs, tmp_path):
    raw, master = inputs
    store = Store(str(tmp_path), period="year")
    for n in range(4):
        run_batch(raw.where(F.col("ingest_seq") % 4 == n), master, store, f"b{n}", as_of=fx.AS_OF)
    before = {k: v[:2] for k, v in reports_of(store, spark).items()}
    told = sorted(r.news_id for r in store.announcements(spark).collect())
    files = len(rows_of(tmp_path))
    names = [f"b{n}" for n in range(4)]
    counts = compact(spark, store, "merged", names)
    assert len(rows_of(tmp_path)) == sum(counts.values()) < files
    assert {k: v[:2] for k, v in reports_of(store, spark).items()} == before
    assert sorted(r.news_id for r in store.announcements(spark).collect()) == told
    assert compact(spark, store, "merged2", ["merged"])["reports"] == counts["reports"]
    again = run_batch(raw, master, store, "b1", as_of=fx.AS_OF)
    assert again == {"announcements": 0, "reports": 0}


def test_failed_compaction_is_finished_later(spark, tmp_path, monkeypatch):
    store, master = Store(str(tmp_path)), case_master(spark)
    run_batch(case_raw(spark, ("a", AUG1)), master, store, "b1", as_of=fx.AS_OF)
    run_batch(case_raw(spark, ("b", AUG1), ("c", NOV1)), master, store, "b2", as_of=fx.AS_OF)
    before = sorted(r.report_id for r in store.reports(spark).collect())
    real = compacting.hadoop_path
    with monkeypatch.context() as m:
        m.setattr(compacting, "hadoop_path", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            compact(spark, store, "m", ["b1", "b2"])
    assert compacting.hadoop_path is real
    compact(spark, store, "m", ["b1", "b2"])
    assert sorted(r.report_id for r in store.reports(spark).collect()) == before
    assert {r.batch for r in store.announcements(spark).collect()} == {"m"}
