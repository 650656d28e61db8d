"""The live run as a stream of landed files."""

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from filingloom.functions.dates import parse_trade_date, timestamp
from filingloom.functions.text import strip, without_last_chars
from filingloom.operators.announcements import ATTACHMENT_SUFFIX
from filingloom.plans.ingest import Store, run_batch
from filingloom.rules import CATEGORY_RULES, REPORT_CODES, Rule
from filingloom.sinks.tables import write_batch
from filingloom.sinks.workspace import child_folders, delete_folder, scratch
from filingloom.sources.landed import with_arrival_order
from filingloom.sources.requests import LIVE_DAYS
from filingloom.streaming.dedup import dedup_within_watermark

# Fixed value: time between two live runs.
LIVE_INTERVAL = "1 minute"
# Settings of a stream's state unless the session has its own: kept on the executors' disks, with bounded memory, as
# there is a row of state for every id of the delay.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
# Parts of the state per core: each is loaded and committed by every micro-batch, however few rows it gets.
STATE_PARTS_PER_CORE = 2
# Stored ids are cut down to those of a micro-batch, which is read twice for it, if they are so many times its rows.
NARROW_FROM = 10
# The trade time that rows of a micro-batch bring along.
TRADED = "_traded"


def _query_id(batch: DataFrame) -> str:
    """Id of the running stream: fixed by its checkpoint, so it survives restarts."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("this session does not tell the stream's id: name the stream")
    return found


def _clock(spark: SparkSession, folder: str, batch_id: int, now: datetime) -> datetime:
    """The time of a micro-batch: that of its first attempt, so that a replay makes the same rows.

    Times of earlier micro-batches, which are committed by now, are removed.
    """
    name = f"{batch_id:09d}"
    kept = child_folders(spark, folder)
    for other in kept:
        if other != name:
            delete_folder(spark, f"{folder}/{other}")
    if name in kept:
        found = spark.read.text(f"{folder}/{name}").first()
        if found is not None:
            return datetime.fromisoformat(found.value)
    _note(spark, f"{folder}/{name}", now)
    return now


def _note(spark: SparkSession, path: str, moment: datetime | None) -> None:
    """Write one moment, or that there is none, as a text."""
    one = spark.range(0, 1, 1, 1).select(F.lit(moment and moment.isoformat()).cast("string").alias("value"))
    one.where("value is not null").write.mode("overwrite").text(path)


def _traded(raw: DataFrame) -> Column:
    """The trade time of raw rows: parsed, unless they bring it along."""
    if TRADED in raw.columns:
        return F.col(TRADED)
    return parse_trade_date(strip(F.col("Tradedate")))


def _high_water(folder: str, batch_id: int, rows: DataFrame, moment: datetime) -> datetime | None:
    """The latest trade time of all earlier micro-batches; the one up to this batch is noted for the next.

    A micro-batch that is replayed finds what its first attempt found, and notes the same. Times after
    ``moment`` are no trades yet: one of them would make all that follows late.
    """
    spark = rows.sparkSession
    earlier = [name for name in child_folders(spark, folder) if int(name) < batch_id]
    found = spark.read.text(f"{folder}/{earlier[-1]}").first() if earlier else None
    high = datetime.fromisoformat(found.value) if found is not None else None
    dt = _traded(rows)
    own = rows.where(dt <= timestamp(moment)).agg(F.max(dt)).first()[0]
    reached = max((t for t in (high, own) if t is not None), default=None)
    _note(spark, f"{folder}/{batch_id:09d}", reached)
    for name in earlier[:-1]:
        delete_folder(spark, f"{folder}/{name}")
    return high


def first_arrivals(raw: DataFrame, delay: str) -> DataFrame:
    """The stream without rows whose news id has arrived in the ``delay`` before, by the stream's state.

    A row without a PDF or a valid date has no say about its id: only its exact repeats go. Of copies in
    one micro-batch any may stay, and rows of one block of a file may change places. The state goes by the time of the micro-batch, which never runs back, so
    no row is dropped as late here.
    """
    name = strip(F.col("AttachmentName"))
    news_id = without_last_chars(name, len(ATTACHMENT_SUFFIX))
    own = F.sha2(F.to_json(F.struct(*(f"`{c}`" for c in raw.columns if c not in ("ingest_file", "ingest_seq")))), 256)
    good = name.endswith(ATTACHMENT_SUFFIX) & _traded(raw).isNotNull()
    named = raw.withColumns(
        {
            "_key": F.when(good, F.concat(F.lit("id "), news_id)).otherwise(F.concat(F.lit("row "), own)),
            "_arrived": F.current_timestamp(),
        }
    )
    return dedup_within_watermark(named, "_key", "_arrived", delay).drop("_key", "_arrived")


@contextmanager
def _state_settings(spark: SparkSession) -> Iterator[None]:
    """Settings that a stream with state starts with; the session has its own ones again afterwards.

    A stream keeps the settings of its first start with its checkpoint, so one that was begun with others goes on with those.
    """
    parts = "spark.sql.shuffle.partitions"
    ordinary = int(spark.conf.get(parts))
    wanted = {parts: str(min(ordinary, STATE_PARTS_PER_CORE * spark.sparkContext.defaultParallelism))}
    wanted |= {key: value for key, value in STATE_SETTINGS.items() if spark.conf.get(key, None) is None}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def not_late(raw: DataFrame, since: datetime) -> DataFrame:
    """Rows traded since then; rows without a valid date stay for the cleaning to judge."""
    dt = _traded(raw)
    return raw.where(dt.isNull() | (dt >= timestamp(since)))


def late(raw: DataFrame, since: datetime) -> DataFrame:
    """The other rows: traded before."""
    return raw.where(_traded(raw) < timestamp(since))


def run_stream(
    raw: DataFrame,
    master: Callable[[], DataFrame],
    store: Store,
    checkpoint: str,
    *,
    available_now: bool = False,
    live_days: int | None = LIVE_DAYS,
    late_after: timedelta | None = None,
    dedup_delay: str | None = None,
    now: Callable[[], datetime] = datetime.now,
    rules: Sequence[Rule] = CATEGORY_RULES,
    codes: dict[str, str] = REPORT_CODES,
    order_by: Sequence[str] = ("ingest_seq",),
    interval: str = LIVE_INTERVAL,
    name: str | None = None,
    report: Callable[[str, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Ingest a stream of raw announcements; ``available_now`` stops when all files are read.

    Every micro-batch is a ``run_batch``: duplicates inside it are resolved by rank, duplicates of
    earlier batches by the stored ids of the last ``live_days`` days, and rows older than that are
    late: they are counted and written to the table ``late`` of the store as they came, where
    ``run_batch`` can take them up (``None`` keeps them in and compares with all stored ids).
    ``late_after`` goes by event time instead: late is what was traded so long before the latest trade
    of the micro-batches before, restarts included. With ``dedup_delay`` (as "5 days") the stream's
    state drops repeats of ids that arrived less than that before, so that they reach neither the
    cleaning nor the stored ids, whatever became of the first one: see ``first_arrivals``. The
    stored tables are the state, so numbers continue across batches and restarts. Output is labelled
    with ``name``, or else the id of the checkpoint, and the batch number: a replayed batch has the
    time of its first attempt and replaces its own output. The company master is read anew for each
    batch. ``report`` gets the label and the counts of every batch.
    """

    session = raw.sparkSession

    def ingest(batch: DataFrame, batch_id: int) -> None:
        rows = with_arrival_order(batch) if "ingest_file" in batch.columns else batch
        if dedup_delay is None and late_after is None and live_days is None:
            take(rows, batch_id)
            return
        # Late rows and the others are read apart: each reader would parse the files, or run through
        # the state, again. The session of a stream with state has no adaptive execution, so the copy is
        # read by the one that started the stream.
        dated = rows.withColumn(TRADED, _traded(rows))
        with scratch(dated, "micro-batch", Store.VARIOUS_IN_ANNOUNCEMENTS, session) as kept:
            # The state has micro-batches of its own, to forget what is old.
            if dedup_delay is None or not kept.isEmpty():
                take(kept, batch_id)

    def take(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        stream = name or _query_id(rows)
        label = f"{stream}-{batch_id:09d}"
        moment = _clock(spark, f"{store.root}/_clocks/{stream}", batch_id, now())
        since, n_late, few = None, 0, False
        if late_after is not None:
            high = _high_water(f"{store.root}/_marks/{stream}", batch_id, rows, moment)
            since = high and high - late_after
        elif live_days is not None:
            today: date = moment.date()
            since = datetime.combine(today - timedelta(days=live_days - 1), time())
        if since is not None:
            few = rows.count() * NARROW_FROM <= store.announcements(spark, since).count()
            n_late = write_batch(
                late(rows, since).drop(TRADED), store.late_path, label, (), "parquet", Store.VARIOUS_IN_ANNOUNCEMENTS
            )
            rows = not_late(rows, since)
        counts = run_batch(
            rows.drop(TRADED),
            master(),
            store,
            label,
            as_of=moment.replace(microsecond=0),
            since=since,
            rules=rules,
            codes=codes,
            order_by=order_by,
            dedup="after_parse",
            narrow_first=few,
        )
        if report is not None:
            report(label, {**counts, "late": n_late})

    if dedup_delay is not None:
        raw = first_arrivals(raw, dedup_delay)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    writer = raw.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint).trigger(**trigger)
    if dedup_delay is None:
        return writer.start()
    with _state_settings(session):
        return writer.start()
