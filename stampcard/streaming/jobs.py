"""The two streaming jobs: award points, and keep the ledger.

Both run the set form of the decision rule once per micro-batch. A batch is
first written to a staging folder. It is then read by several joins without
going back to the source, and under the caller's session, where adaptive
execution is on; inside a stream's own session Spark turns it off.

Batches are named after the query and the batch number. A batch that runs
again under the same name overwrites its own rows, ignores them when it reads,
and uses the clock of its first run.
"""

from __future__ import annotations

import datetime as dt
import itertools
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stampcard.config import EngineConfig
from stampcard.functions.rules import (
    ACCEPT,
    DUP_LEDGER,
    DUP_STATE,
    LIMIT,
    to_processed,
    to_transactions,
)
from stampcard.operators.decide import EVENT_KEY, apply_verdicts, verdicts, with_orders
from stampcard.operators.ledger import apply_ledger
from stampcard.schemas import LEDGER_DDL
from stampcard.session import folder_names, remove_path
from stampcard.sources import kafka, wire
from stampcard.sources.database import DatabaseLedger
from stampcard.sources.tables import BatchJournal, FileLedger, month_range

LOG = logging.getLogger(__name__)

# The folder of the empty day every memory starts with.
FIRST_DAY = dt.date(1970, 1, 1)

Clock = Callable[[], dt.datetime]
Ledger = FileLedger | DatabaseLedger
Sink = Callable[[DataFrame, str], None]


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def time_literal(at: dt.datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def file_sink(path: str) -> Sink:
    """Write each batch's transactions to its own folder."""

    def write(transactions: DataFrame, batch: str) -> None:
        transactions.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")

    return write


def kafka_sink(cfg: EngineConfig) -> Sink:
    """Send each user's records in the order of arrival."""
    return lambda transactions, batch: kafka.write_transactions(transactions, cfg)


def by_user(transactions: DataFrame) -> DataFrame:
    """A batch's transactions as a sink gets them: a user's rows in one
    partition, which is where a broker's key puts them anyway, by arrival."""
    return transactions.repartition("user_id").sortWithinPartitions("user_id", "arrival_seq")


def observe_outcomes(decided: DataFrame, name: str = "outcomes") -> tuple[DataFrame, Observation]:
    """Count outcomes while the rows pass by, without a job of its own."""
    observation = Observation(name)
    counts = [
        F.count(F.when(F.col("status") == status, 1)).alias(status)
        for status in (ACCEPT, DUP_STATE, DUP_LEDGER, LIMIT)
    ]
    return decided.observe(observation, *counts), observation


class SeenEvents:
    """(user, event id) pairs marked in the last days, one folder per day and
    batch. Only days within the time to live are read. When a day is over, its
    marks are moved to a folder by bucket, a hash of the event id, of which a
    batch reads the buckets its own ids fall into; days beyond the time to live
    are removed."""

    MARK_DDL = "user_id bigint, event_id string, seen_at timestamp_ntz"
    #: The verdicts that mark an event.
    MARKS = "NOT in_state AND first_arrival = first_mark"
    #: Buckets of a merged day.
    BUCKETS = 64

    DDL = (
        "user_id bigint, event_id string, quota_month date, first_arrival bigint, "
        "month_count bigint, in_ledger boolean, first_mark bigint, in_state boolean, "
        "checkin_order int, seen_at timestamp_ntz"
    )

    def __init__(self, spark: SparkSession, root: str, ttl_ms: int) -> None:
        self.spark = spark
        self.root = f"{root.rstrip('/')}/seen"
        self.ttl = dt.timedelta(milliseconds=ttl_ms)
        self._tidied: dt.date | None = None

    def _folder(self, batch: str, now: dt.datetime) -> str:
        return f"{self.root}/day={now.date().isoformat()}/batch={batch}"

    def write(self, ruled: DataFrame, batch: str, now: dt.datetime) -> None:
        """Keep a batch's verdicts, of which the marking ones are read later."""
        stamped = ruled.withColumn("seen_at", time_literal(now))
        stamped.write.mode("overwrite").parquet(self._folder(batch, now))

    def verdicts_of(self, batch: str, now: dt.datetime) -> DataFrame:
        folder = self._folder(batch, now)
        return self.spark.read.schema(self.DDL).parquet(folder).drop("seen_at")

    def read(self, batch: str, now: dt.datetime, checkins: DataFrame) -> DataFrame:
        """Pairs of ``checkins`` still remembered at ``now``, not from ``batch``
        itself. The memory is far larger than a batch, so it is cut to the
        batch's pairs before it is shuffled where these are few."""
        since = now - self.ttl
        count = (now.date() - since.date()).days + 1
        days = [since.date() + dt.timedelta(days=n) for n in range(count)]
        # Name the days, so that older folders are not even listed; the first
        # day makes sure that there is one.
        names = ",".join(day.isoformat() for day in [FIRST_DAY, *days])
        recent = self._days(f"{self.DDL}, day date, batch string", self.root, names).filter(F.col("batch") != batch)
        buckets = [r[0] for r in checkins.select(self._bucket()).distinct().collect()]
        merged = self._days(f"{self.MARK_DDL}, day date, bucket int", f"{self.root}/merged", names).filter(
            F.col("bucket").isin(buckets)
        )
        rows = recent.filter(self.MARKS).select(*EVENT_KEY, "seen_at").unionByName(merged.select(*EVENT_KEY, "seen_at"))
        return (
            rows.filter(F.col("seen_at") > time_literal(since))
            .select(*EVENT_KEY)
            .join(checkins.select(*EVENT_KEY).distinct(), EVENT_KEY, "left_semi")
            .distinct()
        )

    def _days(self, ddl: str, root: str, names: str) -> DataFrame:
        reader = self.spark.read.schema(ddl).option("basePath", root)
        return reader.parquet(f"{root}/day={FIRST_DAY}", f"{root}/day={{{names}}}")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("event_id"), F.lit(self.BUCKETS)).cast("int").alias("bucket")

    def tidy(self, now: dt.datetime) -> None:
        """Move the marks of days that are over; once a day. One that is found in
        both places, or was moved twice, counts once, as marks are a set."""
        if self._tidied == now.date():
            return
        oldest = (now - self.ttl).date()
        for folder, day in self._stored_days(self.root):
            if day < now.date():
                if day >= oldest:
                    self._move(folder, day)
                remove_path(self.spark, folder)
        for folder, day in self._stored_days(f"{self.root}/merged"):
            if day < oldest:
                remove_path(self.spark, folder)
        self._tidied = now.date()

    def _stored_days(self, root: str) -> list[tuple[str, dt.date]]:
        names = [name for name in folder_names(self.spark, root) if name.startswith("day=")]
        days = [(f"{root}/{name}", dt.date.fromisoformat(name.removeprefix("day="))) for name in names]
        return [(folder, day) for folder, day in days if day != FIRST_DAY]

    def _move(self, folder: str, day: dt.date) -> None:
        batches = [f"{folder}/{name}" for name in folder_names(self.spark, folder) if name.startswith("batch=")]
        if batches:
            marks = self.spark.read.schema(self.DDL).parquet(*batches).filter(self.MARKS)
            rows = marks.select(*EVENT_KEY, "seen_at", self._bucket()).repartition(self.BUCKETS, "bucket")
            rows.write.mode("append").partitionBy("bucket").parquet(f"{self.root}/merged/day={day}")

    def create(self) -> None:
        """An empty day, so that the first batch finds a table to read."""
        empty = self.spark.createDataFrame([], self.DDL)
        empty.write.mode("ignore").parquet(f"{self.root}/day={FIRST_DAY}/batch=initial")
        marks = empty.select(*EVENT_KEY, "seen_at", self._bucket())
        marks.write.mode("ignore").partitionBy("bucket").parquet(f"{self.root}/merged/day={FIRST_DAY}")


@dataclass(frozen=True)
class Batch:
    """One micro-batch ready to be worked on."""

    name: str
    now: dt.datetime
    checkins: DataFrame


class Job:
    """What both jobs do around a batch.

    ``on_error`` says how raw records (``value``, ``arrival_seq``) are decoded,
    see ``decode_checkins``; unusable ones are put aside by batch. Leave it
    out if the stream holds check-ins already. ``state`` is a shared folder
    that belongs to this job alone.
    """

    def __init__(
        self,
        spark: SparkSession,
        cfg: EngineConfig,
        state: str,
        on_error: str | None = None,
        clock: Clock = utc_now,
    ) -> None:
        self.spark = spark
        self.cfg = cfg
        self.state = state.rstrip("/")
        self.on_error = on_error
        self.clock = clock
        self.journal = BatchJournal(spark, state)

    def work(self, batch: Batch) -> None:
        raise NotImplementedError

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        # A checkpoint keeps its query id and a new checkpoint has a new one,
        # so a new query's batch 0 is never taken for an old one's.
        query_id = batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("not called from a streaming query")
        self.run(batch_df, f"{query_id}-{batch_id}")

    def run(self, batch_df: DataFrame, name: str) -> None:
        if self.journal.time_of(name, "finished"):
            LOG.info("batch %s is finished already", name)
            return
        now = self.journal.clock(name, self.clock())
        self.work(Batch(name, now, self._staged(batch_df, name)))
        self.journal.note(name, "finished", now)
        self.journal.forget_before(name)
        self.tidy(name, now)

    def tidy(self, name: str, now: dt.datetime) -> None:
        """What may be done between two batches."""

    def _staged(self, batch_df: DataFrame, name: str) -> DataFrame:
        if self.on_error is None:
            return self.cut(batch_df, "staged")
        staged = self.cut(wire.decode_checkins(batch_df, on_error=self.on_error), "staged")
        if self.on_error == "fail":
            return staged
        good, bad = wire.split_quarantine(staged)
        bad.write.mode("overwrite").parquet(f"{self.state}/quarantine/batch={name}")
        return good

    def looked_up(self, ledger: Ledger, batch: Batch) -> tuple[DataFrame, DataFrame]:
        """The daily rows and logged ids a batch can meet, read now. A ledger is
        far larger than a batch, so only these take part in the joins."""
        months = month_range(batch.checkins)
        if months is None:
            # A batch without rows asks the ledger nothing.
            none = self.spark.createDataFrame([], LEDGER_DDL["daily_checkin"])
            return none, self.spark.createDataFrame([], "event_id string")
        daily, logged = ledger.lookup(batch.checkins, months, batch.name)
        return self.cut(daily, "daily"), self.cut(logged, "logged")

    def ruled(self, rows: DataFrame) -> DataFrame:
        """Verdicts with orders; each round of settling has a folder."""
        rounds = itertools.count()
        return with_orders(rows, self.cfg, lambda df: self.cut(df, f"round{next(rounds)}"))

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` to a work folder, used again by the next batch, and
        return it as written."""
        folder = f"{self.state}/work/{name}"
        df.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)


class LiveJob(Job):
    """Decide a batch and send the transactions of its accepted check-ins."""

    def __init__(
        self,
        spark: SparkSession,
        cfg: EngineConfig,
        ledger: Ledger,
        sink: Sink,
        state: str,
        on_error: str | None = None,
        clock: Clock = utc_now,
    ) -> None:
        super().__init__(spark, cfg, state, on_error, clock)
        self.ledger = ledger
        self.sink = sink
        self.seen = SeenEvents(spark, state, cfg.state_ttl_ms)
        self.seen.create()

    def work(self, batch: Batch) -> None:
        # Once ruled on, a batch is not ruled on again: a repeat sends the same
        # transactions even if the ledger has moved on in between.
        if not self.journal.time_of(batch.name, "ruled"):
            daily, logged = self.looked_up(self.ledger, batch)
            seen = self.seen.read(batch.name, batch.now, batch.checkins)
            ruled = self.ruled(verdicts(batch.checkins, daily, logged, self.cfg, seen))
            self.seen.write(ruled, batch.name, batch.now)
            self.journal.note(batch.name, "ruled", batch.now)
        kept = self.seen.verdicts_of(batch.name, batch.now)
        decided, outcomes = observe_outcomes(apply_verdicts(batch.checkins, kept))
        accepted = decided.filter(F.col("status") == ACCEPT)
        # Cut before it is handed over: a sink may run several actions, or none,
        # and the counts below wait for one.
        rows = to_transactions(accepted, self.cfg, time_literal(batch.now), ["arrival_seq"])
        sent = self.cut(rows, "sent")
        self.sink(by_user(sent).drop("arrival_seq"), batch.name)
        LOG.info("batch %s: %s", batch.name, outcomes.get)

    def tidy(self, name: str, now: dt.datetime) -> None:
        self.ledger.release(name)
        self.seen.tidy(now)


class LedgerJob(Job):
    """Decide a batch and apply it to the ledger.

    The event log is the state here: whatever was decided before is logged
    there, for good and for any user, so no list of seen events is kept. A
    batch that the ledger has is not decided again. ``merge_every`` batches of a
    file ledger are merged into one folder, between two batches.
    """

    def __init__(
        self,
        spark: SparkSession,
        cfg: EngineConfig,
        ledger: Ledger,
        state: str,
        on_missing: str = "fail",
        on_error: str | None = None,
        clock: Clock = utc_now,
        merge_every: int = 16,
    ) -> None:
        super().__init__(spark, cfg, state, on_error, clock)
        self.ledger = ledger
        self.on_missing = on_missing
        self.merge_every = merge_every

    def tidy(self, name: str, now: dt.datetime) -> None:
        self.ledger.release(name)
        if isinstance(self.ledger, FileLedger):
            self.ledger.merge_batches(self.merge_every)

    def work(self, batch: Batch) -> None:
        if self.ledger.has(batch.name):
            LOG.info("batch %s is in the ledger already", batch.name)
            return
        daily, logged = self.looked_up(self.ledger, batch)
        ruled = self.cut(self.ruled(verdicts(batch.checkins, daily, logged, self.cfg)), "ruled")
        decided, outcomes = observe_outcomes(apply_verdicts(batch.checkins, ruled))
        processed = self.cut(to_processed(decided, self.cfg), "processed")
        LOG.info("batch %s: %s", batch.name, outcomes.get)
        now = time_literal(batch.now)
        users = self.ledger.known_users(batch.checkins, batch.name)
        changes = apply_ledger(
            processed,
            users,
            daily,
            logged,
            now,
            self.on_missing,
            cut=lambda rows: self.cut(rows, "applied"),
        )
        if self.on_missing == "quarantine":
            changes.unknown_user_rows.write.mode("overwrite").parquet(
                f"{self.state}/unknown_users/batch={batch.name}"
            )
        self.ledger.append(changes, now, batch.name)


def start(
    checkins: DataFrame, job: Job, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Run ``job`` on a stream, every checkpoint interval or until what is
    there now is used up.

    The checkpoint is kept when the query stops; starting again on it goes on
    where it ended.
    """
    writer = checkins.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{job.cfg.checkpoint_interval_ms} milliseconds").start()


def start_live_stream(
    checkins: DataFrame, job: LiveJob, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Award points for a stream of check-ins."""
    return start(checkins, job, checkpoint, available_now)


def apply_ledger_stream(
    checkins: DataFrame, job: LedgerJob, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Audit a stream of check-ins and keep the ledger up to date."""
    return start(checkins, job, checkpoint, available_now)
