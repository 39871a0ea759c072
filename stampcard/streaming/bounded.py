"""Streaming jobs run over the whole ``events`` table, in three batches.

The derived check-ins are put into a stream's folder in three ranges of their
arrival, each when the stream has worked on the one before and was stopped, so
state, marks, journal and ledger are carried from batch to batch and over
restarts. The clock moves by ``STEP`` with each: marks of the first batch have
expired in the third one, those of the second have not. The middle range is
short enough for copies to reach from the first range into the third.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stampcard.config import EngineConfig
from stampcard.plans import workload as W
from stampcard.session import scratch_path, tune
from stampcard.sources.tables import FileLedger
from stampcard.streaming.dedup_state import dedup_stream as first_arrivals
from stampcard.streaming.jobs import Job, LedgerJob, LiveJob, file_sink, start

STEP = dt.timedelta(days=4)
#: Arrivals in the middle range.
MIDDLE = 1500


def clock_of(batch: int) -> dt.datetime:
    return dt.datetime.fromisoformat(W.NOW) + batch * STEP


def ranges(raw: DataFrame) -> list[DataFrame]:
    """The check-ins by arrival: about one half, ``MIDDLE`` arrivals, the rest.
    Each is derived from the events that can fall into it: a check-in arrives
    with its event or, as a copy, up to ``W.LATEST_COPY`` later."""
    most = raw.agg(F.max("event_id")).head()[0] or 0
    first = most * 10 // 2
    event, arrival = F.col("event_id"), F.col("arrival_seq")
    found = []
    for low, high in ((None, first), (first, first + MIDDLE), (first + MIDDLE, None)):
        some, bound = F.lit(True), F.lit(True)
        if low is not None:
            some, bound = some & (event >= (low - W.LATEST_COPY) // 10), bound & (arrival >= low)
        if high is not None:
            some, bound = some & (event <= high // 10), bound & (arrival < high)
        found.append(W.checkins_of(raw.filter(some)).filter(bound))
    return found


def batches(spark: SparkSession, sf_dir: str, folder: str, clock: bool = False) -> Iterator[int]:
    """Put one range after another into ``folder``; with ``clock`` its time in
    milliseconds is a column ``now_ms``."""
    raw = W.events(spark, sf_dir)
    for n, rows in enumerate(ranges(raw)):
        if clock:
            millis = clock_of(n).replace(tzinfo=dt.timezone.utc).timestamp() * 1000
            rows = rows.withColumn("now_ms", F.lit(round(millis)).cast("bigint"))
        rows.write.mode("append").parquet(folder)
        yield n


def dedup_stream(spark: SparkSession, sf_dir: str, cfg: EngineConfig) -> DataFrame:
    tune(spark, streaming=True)
    root = scratch_path(spark, "dedup-stream")
    kept = "event_id string, user_id bigint, arrival_seq bigint"
    for _ in batches(spark, sf_dir, f"{root}/in", clock=True):
        rows = spark.readStream.schema(f"{kept}, now_ms bigint").parquet(f"{root}/in")
        query = (
            first_arrivals(rows, cfg.state_ttl_ms, clock_col="now_ms")
            .drop("now_ms")
            .writeStream.format("parquet")
            .option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.schema(kept).parquet(f"{root}/out")


def _new_ledger(spark: SparkSession, sf_dir: str, cfg: EngineConfig, root: str) -> FileLedger:
    raw = W.events(spark, sf_dir)
    return FileLedger(spark, f"{root}/ledger").create(
        W.users(spark, sf_dir), W.daily_checkin_of(raw, cfg), W.checkin_events_of(raw)
    )


def _run(spark: SparkSession, sf_dir: str, root: str, job_at: Callable[[int], Job]) -> None:
    schema = W.checkins_of(W.events(spark, sf_dir)).schema
    for n in batches(spark, sf_dir, f"{root}/in"):
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        start(stream, job_at(n), f"{root}/checkpoint", available_now=True).awaitTermination()


def live_stream(spark: SparkSession, sf_dir: str, cfg: EngineConfig) -> DataFrame:
    tune(spark, streaming=True)
    root = scratch_path(spark, "live-stream")
    ledger = _new_ledger(spark, sf_dir, cfg, root)

    def job(n: int) -> Job:
        return LiveJob(
            spark, cfg, ledger, file_sink(f"{root}/out"), f"{root}/state", clock=lambda: clock_of(n)
        )

    _run(spark, sf_dir, root, job)
    return spark.read.parquet(f"{root}/out").drop("batch")


def ledger_stream(spark: SparkSession, sf_dir: str, cfg: EngineConfig) -> DataFrame:
    """Balances after all batches; the first two are merged on the way."""
    tune(spark, streaming=True)
    root = scratch_path(spark, "ledger-stream")
    ledger = _new_ledger(spark, sf_dir, cfg, root)

    def job(n: int) -> Job:
        return LedgerJob(
            spark, cfg, ledger, f"{root}/state", "quarantine", clock=lambda: clock_of(n), merge_every=2
        )

    _run(spark, sf_dir, root, job)
    return ledger.users()
