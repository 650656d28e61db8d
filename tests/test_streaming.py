"""The live run as a stream: restarts, repeats, late rows, failures."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from filingloom.operators.master import company_master
from filingloom.plans import ingest
from filingloom.plans.ingest import Store
from filingloom.schemas import COMPANY_MASTER
from filingloom.sinks.workspace import child_folders, matching_files
from filingloom.sources.landed import stream_announcements
from filingloom.streaming import live as streaming
from filingloom.streaming.dedup import dedup_within_watermark
from filingloom.streaming.live import run_stream

NOW = datetime(2025, 9, 10, 15, 30)


def master(spark):
    rows = [(str(c), f"N{c}", f"Company {c}", f"INE{c}", 1.0, c) for c in range(5)]
    return lambda: company_master(spark.createDataFrame(rows, COMPANY_MASTER))


def record(news_id, company=1, at="10/09/2025 10:00:00", headline="Credit Rating"):
    return {
        "AttachmentName": f"{news_id}.pdf",
        "SCRIP_CD": company,
        "Tradedate": at,
        "HeadLine": headline,
        "NewsBody": news_id,
    }


class Live:
    """A landing folder, a store and a checkpoint."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        (path / "landed").mkdir()
        self.store = Store(str(path / "store"))
        self.files = 0

    def land(self, *records):
        text = "\n".join(json.dumps(r) for r in records)
        (self.path / f"part-{self.files}.tmp").write_text(text)
        os.utime(self.path / f"part-{self.files}.tmp", (1e9 + self.files, 1e9 + self.files))
        (self.path / f"part-{self.files}.tmp").rename(
            self.path / "landed" / f"part-{self.files}.json"
        )
        self.files += 1

    def run(self, **options):
        stream = stream_announcements(
            self.spark, str(self.path / "landed"), max_files_per_trigger=1
        )
        options = {"now": lambda: NOW, "available_now": True, **options}
        query = run_stream(
            stream, master(self.spark), self.store, str(self.path / "checkpoint"), **options
        )
        query.awaitTermination()

    def announcements(self):
        return sorted(r.news_id for r in self.store.announcements(self.spark).collect())

    def reports(self):
        rows = self.store.reports(self.spark).collect()
        return {r.news_id: r.report_id for r in rows}


@pytest.fixture
def live(spark, tmp_path):
    return Live(spark, tmp_path)


def test_restart_repeats_and_late_rows(live):
    live.land(record("a"), record("b", at="10/09/2025 09:00:00"), record("a", headline="x"))
    live.land(
        record("a", headline="Annual Report"),
        record("late", at="05/09/2025 23:59:59"),
        record("edge", at="06/09/2025 00:00:00"),
        record("bad", at="n/a"),
        record("stranger", company=99),
    )
    live.run()
    assert live.announcements() == ["a", "b", "edge"]
    assert live.reports() == {
        "a": "INE1_CR_FY2025Q1_2",
        "b": "INE1_CR_FY2025Q1_1",
        "edge": "INE1_CR_FY2025Q1_3",
    }
    live.land(record("b"), record("c", at="07/09/2025 10:00:00"), record("bad"))
    live.run()
    assert live.announcements() == ["a", "b", "bad", "c", "edge"]
    assert live.reports()["c"] == "INE1_CR_FY2025Q1_4"
    assert live.reports()["bad"] == "INE1_CR_FY2025Q1_5"
    live.run()
    assert len(live.announcements()) == 5


@pytest.mark.parametrize("options", [{}, {"late_after": timedelta(days=5)}])
def test_late_rows_are_found_without_parsing_the_files_again(live, monkeypatch, options):
    plans, write = [], streaming.write_batch

    def noted(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, *args)

    monkeypatch.setattr(streaming, "write_batch", noted)
    for number in (1, 2):  # the first micro-batch has no mark to be late by
        live.land(record(f"new{number}"), record(f"old{number}", at="10/09/2001 10:00:00"))
        live.run(**options)
    assert plans and all("json" not in plan for plan in plans)
    assert "new1" in live.announcements() and "old2" not in live.announcements()


def test_event_time_decides_what_is_late_across_restarts(live):
    day = "{:02d}/08/2025 10:00:00".format
    live.land(record("first", at=day(1)), record("future", at="01/01/2099 00:00:00"))
    live.land(record("high", at=day(20)), record("old", at=day(2)))
    options = {"late_after": timedelta(days=5)}
    live.run(**options)
    # Nothing is late before the mark has moved; what lies ahead of the clock does not move it.
    assert live.announcements() == ["first", "future", "high", "old"]
    live.land(record("too late", at=day(14)), record("edge", at=day(15)), record("bad", at="n/a"))
    live.run(**options)
    assert live.announcements() == ["edge", "first", "future", "high", "old"]
    late = live.spark.read.parquet(live.store.late_path)
    assert [r.AttachmentName for r in late.collect()] == ["too late.pdf"]
    live.land(record("later", at=day(16)))
    live.run(**options)
    assert "later" in live.announcements()


def test_a_failed_batch_finds_the_same_mark_again(live, monkeypatch):
    day, options = "{:02d}/08/2025 10:00:00".format, {"late_after": timedelta(days=5), "name": "live"}
    live.land(record("high", at=day(20)))
    live.run(**options)
    live.land(record("higher", at=day(30)), record("edge", at=day(16)))
    write = ingest.write_batch
    monkeypatch.setattr(ingest, "write_batch", lambda *a, **k: 1 / 0)
    with pytest.raises(StreamingQueryException):
        live.run(**options)
    monkeypatch.setattr(ingest, "write_batch", write)
    live.run(**options)
    assert live.announcements() == ["edge", "high", "higher"]


def test_state_drops_repeats_across_restarts(live):
    counts = []
    options = {"dedup_delay": "5 days", "live_days": None, "report": lambda label, told: counts.append(told)}
    live.land(record("a"), record("b"), record("stranger", company=99), record("n", at="n/a"))
    live.land(record("a", headline="Annual Report"), record("c"), record("n"))
    live.run(**options)
    live.land(record("a"), record("b"), record("c"), record("n"), record("stranger", company=1), record("d"))
    live.run(**options)
    assert live.announcements() == ["a", "b", "c", "d", "n"]
    assert [c["announcements"] for c in counts if c["announcements"]] == [2, 2, 1]
    # The state lost nothing but repeats: a row with a bad date did not hide the good one after it.
    stored = live.store.announcements(live.spark).where("news_id = 'a'").collect()
    assert [r.HeadLine for r in stored] == ["credit rating"] or [r.category for r in stored] == ["Credit Rating"]


def test_history_without_a_window(live):
    live.land(record("old", at="01/01/2020 00:00:00"))
    live.land(record("old", at="01/01/2020 00:00:00"), record("new"))
    live.run(live_days=None)
    assert live.announcements() == ["new", "old"]


@pytest.mark.parametrize("step", ["store_announcements", "store_reports"])
def test_failure_after_a_write_and_before_the_commit(live, monkeypatch, step):
    live.land(record("a"), record("g", headline="x"))
    live.run()
    live.land(record("b"), record("c", company=2), record("a"))
    real = getattr(ingest, step)

    def write_then_fail(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, step, write_then_fail)
        with pytest.raises(StreamingQueryException):
            live.run()
    live.land(record("d"))
    live.run()
    assert live.announcements() == ["a", "b", "c", "d", "g"]
    assert live.reports() == {
        "a": "INE1_CR_FY2025Q1_1",
        "b": "INE1_CR_FY2025Q1_2",
        "c": "INE2_CR_FY2025Q1_1",
        "d": "INE1_CR_FY2025Q1_3",
    }


def test_polling_trigger(live):
    """The endless form: rows that land while it runs are picked up."""
    live.land(record("a"))
    stream = stream_announcements(live.spark, str(live.path / "landed"))
    query = run_stream(
        stream, master(live.spark), live.store, str(live.path / "c"), now=lambda: NOW, interval="1 second"
    )
    try:
        query.processAllAvailable()
        live.land(record("b"), record("a"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert live.announcements() == ["a", "b"]


def test_new_checkpoint_keeps_old_output(live):
    live.land(record("a"))
    live.run()
    live.land(record("b"))
    stream = stream_announcements(live.spark, str(live.path / "landed"))
    run_stream(
        stream,
        master(live.spark),
        live.store,
        str(live.path / "other"),
        available_now=True,
        now=lambda: NOW,
    ).awaitTermination()
    assert live.announcements() == ["a", "b"]
    assert live.reports()["b"] == "INE1_CR_FY2025Q1_2"


def test_watermark_dedup(spark, tmp_path):
    """A row beyond the watermark goes once two files have moved it on."""
    files = [
        [("a", 1), ("a", 1), ("b", 1)],
        [("a", 2), ("c", 12)],
        [("d", 13)],
        [("late", 2), ("e", 13)],
    ]
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    stream = (
        spark.readStream.schema("news_id string, day int")
        .option("maxFilesPerTrigger", 1)
        .json(str(source))
        .withColumn("dt", F.expr("make_timestamp(2025, 1, day, 0, 0, 0)"))
    )
    dropped = 0
    for number, rows in enumerate(files):
        text = "\n".join(json.dumps({"news_id": i, "day": d}) for i, d in rows)
        (source / f"{number}.json").write_text(text)
        query = (
            dedup_within_watermark(stream)
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        dropped += sum(
            s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators
        )
    ids = sorted(r.news_id for r in spark.read.parquet(out).collect())
    assert ids == ["a", "b", "c", "d", "e"] and dropped > 0


def test_a_stream_with_state_writes_few_files(live):
    """The session of such a stream has no adaptive execution; its micro-batches are stored by one that has."""
    live.land(*(record(f"n{i}") for i in range(400)))
    live.run(dedup_delay="5 days", live_days=None)
    assert len(live.announcements()) == len(live.reports()) == 400
    for path in (live.store.announcements_path, live.store.reports_path):
        folders = matching_files(live.spark, f"{path}/*/batch=*/part-*") or matching_files(
            live.spark, f"{path}/*/*/batch=*/part-*"
        )
        assert [len(files) for files in folders.values()] == [1]


def test_the_state_has_parts_by_cores_and_the_session_keeps_its_settings(live):
    keys = ["spark.sql.shuffle.partitions", *streaming.STATE_SETTINGS]
    before = live.spark.conf.get(keys[0])
    live.spark.conf.set(keys[0], "40")
    try:
        live.land(record("a"))
        live.run(dedup_delay="5 days")
        assert [live.spark.conf.get(key, None) for key in keys] == ["40"] + [None] * len(streaming.STATE_SETTINGS)
    finally:
        live.spark.conf.set(keys[0], before)
    parts = [name for name in child_folders(live.spark, str(live.path / "checkpoint" / "state" / "0")) if name.isdigit()]
    assert len(parts) == streaming.STATE_PARTS_PER_CORE * live.spark.sparkContext.defaultParallelism
    live.land(record("a"), record("b"))
    live.run(dedup_delay="5 days")
    assert live.announcements() == ["a", "b"]


def test_state_begun_with_other_settings_goes_on(live, monkeypatch):
    counts = []
    options = {"dedup_delay": "5 days", "live_days": None, "report": lambda label, told: counts.append(told)}
    live.land(record("a"), record("b"))
    with monkeypatch.context() as patch:
        patch.setattr(streaming, "STATE_SETTINGS", {})
        patch.setattr(streaming, "STATE_PARTS_PER_CORE", 1000)
        live.run(**options)
    live.land(record("a"), record("c"))
    # The rows that reach the cleaning tell what the state has dropped.
    offered, batch = [], streaming.run_batch
    monkeypatch.setattr(streaming, "run_batch", lambda rows, *a, **k: offered.append(rows.count()) or batch(rows, *a, **k))
    live.run(**options)
    assert offered == [1] and live.announcements() == ["a", "b", "c"]


def test_only_a_small_micro_batch_is_read_twice_to_narrow_the_stored_ids(live, monkeypatch):
    narrow, batch = [], streaming.run_batch

    def noted(*args, **options):
        narrow.append(options["narrow_first"])
        return batch(*args, **options)

    monkeypatch.setattr(streaming, "run_batch", noted)
    for ids in (range(20), range(10, 30), [5, 40]):
        live.land(*(record(f"n{i}") for i in ids))
        live.run()
    assert narrow == [False, False, True]
    assert live.announcements() == sorted(f"n{i}" for i in [*range(30), 40])
