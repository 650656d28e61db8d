"""One batch from raw announcements to stored announcements and reports."""

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from filingloom.functions.dates import period_start, timestamp
from filingloom.operators.announcements import clean_announcements, with_attachment
from filingloom.operators.counts import run_metrics
from filingloom.operators.numbering import MAX_GROUP_ROWS
from filingloom.operators.reports import build_reports
from filingloom.operators.shape import optional, with_default
from filingloom.plans.report_counts import report_counts
from filingloom.rules import CATEGORY_RULES, DEFAULT_CATEGORY, REPORT_CODES, Rule
from filingloom.schemas import ANNOUNCEMENTS, REPORTS
from filingloom.sinks.archive import archive_jsonl
from filingloom.sinks.tables import other_batches, remove_batch, repeated_keys, write_batch
from filingloom.sinks.workspace import scratch
from filingloom.sources.stored import (
    empty_table,
    existing_news_ids,
    read_partitions,
    read_table,
    since_day,
)


@dataclass(frozen=True)
class Store:
    """Where the two tables live.

    Announcements are partitioned by the start of their period (day, month, quarter or year), so
    that state windows and rechecks read only the periods they need; choose the shortest period that
    still fills files of a good size. Reports are partitioned by calendar quarter and type, because a
    report number counts the reports of one quarter. ``extra`` names further raw fields to keep with
    the announcements. ``keep_counts`` keeps counts per base id beside the reports, for tables in which
    counting a quarter's reports for every batch is too much.
    """

    root: str
    extra: T.StructType = T.StructType()
    period: str = "day"
    keep_counts: bool = False

    ANNOUNCEMENT_PARTITIONS = ("trade_period",)
    REPORT_PARTITIONS = ("quarter_start", "report_type")
    # Columns whose values hardly ever repeat.
    VARIOUS_IN_ANNOUNCEMENTS = (
        "AttachmentName", "Tradedate", "NewsBody", "ATTACHMENTURL", "record", "news_id", "dt",
    )
    VARIOUS_IN_REPORTS = ("news_id", "dt_tm", "url", "report_id", "report_line")

    @property
    def announcements_path(self) -> str:
        return f"{self.root}/announcements"

    @property
    def reports_path(self) -> str:
        return f"{self.root}/reports"

    @property
    def counts_path(self) -> str:
        return f"{self.root}/report_counts"

    def report_counts(self, spark: SparkSession, quarters: Iterable[date] | None = None) -> DataFrame:
        """Numbers used up per base id, from maintained counts: ``base_report_id, n``."""
        return report_counts(spark, self.reports_path, self.counts_path, quarters)

    @property
    def late_path(self) -> str:
        """Raw rows that came too late for a stream."""
        return f"{self.root}/late"

    @property
    def announcements_schema(self) -> T.StructType:
        return T.StructType(self.extra.fields + ANNOUNCEMENTS.fields)

    def announcements(
        self, spark: SparkSession, since: str | datetime | None = None
    ) -> DataFrame:
        """Stored announcements, from the midnight of ``since`` on if given."""
        if since is None:
            return read_table(spark, self.announcements_path, self.announcements_schema)
        first = spark.range(1).select(period_start(timestamp(since), self.period)).first()[0]
        rows = read_partitions(
            spark,
            self.announcements_path,
            self.announcements_schema,
            "trade_period",
            lambda day: day >= first.isoformat(),
        )
        return since_day(rows, since)

    def reports(self, spark: SparkSession, quarters: Iterable[date] | None = None) -> DataFrame:
        """Stored reports, of the named quarters only if given."""
        if quarters is None:
            return read_table(spark, self.reports_path, REPORTS)
        names = {day.isoformat() for day in quarters}
        return read_partitions(
            spark, self.reports_path, REPORTS, "quarter_start", names.__contains__
        )


def store_announcements(clean: DataFrame, store: Store, batch: str) -> int:
    """Write one batch of clean announcements; without categories all are General."""
    rows = with_default(clean, "category", DEFAULT_CATEGORY).withColumn(
        "trade_period", period_start(F.col("dt"), store.period)
    )
    stored_columns = [
        optional(rows, field.name, field.dataType).alias(field.name)
        for field in store.announcements_schema.fields
        if field.name != "batch"
    ]
    return write_batch(
        rows.select(stored_columns),
        store.announcements_path,
        batch,
        Store.ANNOUNCEMENT_PARTITIONS,
        various=Store.VARIOUS_IN_ANNOUNCEMENTS,
    )


def _all_unique(repeated: list) -> None:
    if repeated:
        raise ValueError(f"report ids are or would be stored twice: {repeated}")


def store_reports(
    announcements: DataFrame,
    store: Store,
    batch: str,
    as_of: str | datetime | None = None,
    *,
    codes: dict[str, str] = REPORT_CODES,
    max_group_rows: int = MAX_GROUP_ROWS,
    narrow_first: bool = False,
) -> int:
    """Number and write the reports of stored announcements that have none yet.

    Only stored reports of the announcements' own quarters can share an id or a number with the new
    ones; only their folders are read. Reports that the batch made before keep their numbers if it
    makes them again. Reports are written aside first, and published only if no report id in them is
    stored by then: if one is, another writer was at work; an error says so and the table is as it was.
    A writer that publishes in the same moment is found right after; then this batch is taken out again.
    """
    spark = announcements.sparkSession
    quarters = [
        row[0]
        for row in announcements.select(period_start(F.col("dt"), "quarter")).distinct().collect()
        if row[0] is not None
    ]
    if not quarters:
        return write_batch(
            empty_table(spark, REPORTS).drop("batch"), store.reports_path, batch, Store.REPORT_PARTITIONS
        )
    stored = store.reports(spark, quarters)
    own_numbers = stored.where(F.col("batch") == batch).select(
        "report_type", "news_id", "report_id", "count"
    )
    various = Store.VARIOUS_IN_REPORTS
    with scratch(own_numbers, "own-reports", various) as own:
        reports = build_reports(
            announcements,
            other_batches(stored, batch),
            as_of,
            codes=codes,
            max_group_rows=max_group_rows,
            narrow_first=narrow_first,
            own=None if own.isEmpty() else own,
            counts=store.report_counts(spark, quarters) if store.keep_counts else None,
        )
        with scratch(reports, "reports", various) as aside:
            others = other_batches(store.reports(spark, quarters), batch).select("report_id")
            _all_unique(repeated_keys(others.unionAll(aside.select("report_id")), "report_id"))
            n_reports = write_batch(
                aside, store.reports_path, batch, Store.REPORT_PARTITIONS, various=various
            )
    if n_reports:
        repeated = repeated_keys(store.reports(spark, quarters), "report_id", F.col("batch") == batch)
        if repeated:
            remove_batch(spark, store.reports_path, batch, Store.REPORT_PARTITIONS)
        _all_unique(repeated)
    return n_reports


def run_batch(
    raw: DataFrame,
    master: DataFrame,
    store: Store,
    batch: str,
    *,
    as_of: str | datetime | None = None,
    since: str | datetime | None = None,
    rules: Sequence[Rule] = CATEGORY_RULES,
    codes: dict[str, str] = REPORT_CODES,
    order_by: Sequence[str] = ("ingest_seq",),
    dedup: str = "before_parse",
    preserve_case: bool = False,
    narrow_first: bool = False,
    metrics: bool = False,
    archive: str | None = None,
    fetch_type: str = "hist",
) -> dict[str, int]:
    """Ingest one batch; returns the rows written to each table.

    ``metrics`` adds the counts of ``run_metrics``, which reads the raw rows once more. ``archive``
    names a folder for JSON lines of the raw rows with an attachment and of the stored ones, under
    ``fetch_type``; raw rows need their id first, so rows without an attachment are not archived.

    Announcements are written first and reports are built from what was written, so the cleaning is
    computed once and a batch that runs again under its name rebuilds exactly its own output.
    ``since`` bounds the stored ids a new announcement is compared with; ``narrow_first`` suits a
    small batch against big tables. One writer at a time.
    """
    spark = raw.sparkSession
    earlier = other_batches(store.announcements(spark, since), batch)
    counts = {}
    if metrics:
        counts = run_metrics(raw, master, existing_news_ids(earlier)).first().asDict()
    clean = clean_announcements(
        raw,
        master,
        existing_news_ids(earlier),
        rules=rules,
        order_by=order_by,
        dedup=dedup,
        preserve_case=preserve_case,
        narrow_first=narrow_first,
    )
    n_announcements = store_announcements(clean, store, batch)
    written = store.announcements(spark).where(F.col("batch") == batch)
    n_reports = store_reports(
        written, store, batch, as_of, codes=codes, narrow_first=narrow_first
    )
    if archive is not None:
        named = with_attachment(raw)
        counts["archived_raw"] = archive_jsonl(
            named, archive, batch, "normal", fetch_type, order_by=tuple(order_by)
        )
        counts["archived"] = archive_jsonl(
            written.drop("batch"), archive, batch, "filter", fetch_type, order_by=("dt",)
        )
    return {"announcements": n_announcements, "reports": n_reports, **counts}
