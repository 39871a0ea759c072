"""Either streaming job as a command for spark-submit.

    spark-submit --packages <kafka connector>,<jdbc driver> -m stampcard.job \\
        --kafka.topic checkin.raw --points.sequence 1,2,3 --max.checkin.per.month 7
    spark-submit ... -m stampcard.job --job ledger --ledger hdfs:///rewards/ledger

``--job live`` awards points and sends transactions, ``--job ledger`` audits
the check-ins and applies them to the ledger. The ledger is the database of
the ``mysql`` options, or a folder made by ``FileLedger.create``. Records come
from the broker, or as Parquet files of (key, value, partition, offset) from a
folder; transactions go to the broker or to a folder.

All options have defaults; the names of ``OPTION_FIELDS`` set the job's
settings. The stream's checkpoint and state lie under the session's
``spark.checkpoint.dir``, which must be set, in a folder named after
``--job.name``, so starting the job again under the same name goes on where it
stopped. The shuffle width is the session's unless ``--parallelism`` is given.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stampcard.config import OPTION_FIELDS, EngineConfig
from stampcard.schemas import RAW_RECORD_DDL
from stampcard.session import lasting_path, set_parallelism, tune
from stampcard.sources import kafka
from stampcard.sources.database import DatabaseLedger, JdbcDatabase
from stampcard.sources.tables import FileLedger
from stampcard.streaming.jobs import Job, Ledger, LedgerJob, LiveJob, file_sink, kafka_sink, start

#: What ``--ledger``, ``--source`` and ``--sink`` say for no folder.
DATABASE, BROKER = "database", "kafka"


def positive(text: str) -> int:
    number = int(text)
    if number < 1:
        raise ValueError(text)
    return number


def parse(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="stampcard.job", description=__doc__)
    for name in OPTION_FIELDS:
        parser.add_argument(f"--{name}")
    parser.add_argument("--job", default="live", choices=("live", "ledger"))
    parser.add_argument("--job.name", help="default: award-points or keep-ledger")
    parser.add_argument("--ledger", default=DATABASE, metavar="database|FOLDER")
    parser.add_argument("--source", default=BROKER, metavar="kafka|FOLDER")
    parser.add_argument("--sink", default=BROKER, metavar="kafka|FOLDER", help="of the live job")
    parser.add_argument("--on.error", default="fail", choices=("fail", "quarantine"))
    parser.add_argument("--on.missing", default="fail", choices=("fail", "quarantine"), help="unknown users, of the ledger job")
    parser.add_argument("--order.mode", default="snapshot", choices=("snapshot", "sequential"))
    parser.add_argument("--max.offsets.per.trigger", type=positive)
    parser.add_argument(
        "--ledger.parts", type=positive, default=8, help="tasks that read a batch's rows from the database"
    )
    parser.add_argument("--available.now", action="store_true", help="stop when all there is has been worked on")
    return parser.parse_args(argv)


def config_of(args: argparse.Namespace) -> EngineConfig:
    given = {name: value for name, value in vars(args).items() if value is not None}
    cfg = EngineConfig.from_options({n: v for n, v in given.items() if n in OPTION_FIELDS})
    # A repeated batch must send equal ids, since the Kafka sink may repeat it.
    return cfg.with_(
        order_mode=given["order.mode"],
        id_mode="deterministic",
        max_offsets_per_trigger=given.get("max.offsets.per.trigger"),
    )


def name_of(args: argparse.Namespace) -> str:
    return getattr(args, "job.name") or {"live": "award-points", "ledger": "keep-ledger"}[args.job]


def ledger_of(spark: SparkSession, args: argparse.Namespace, cfg: EngineConfig) -> Ledger:
    if args.ledger == DATABASE:
        return DatabaseLedger(JdbcDatabase(spark, cfg), getattr(args, "ledger.parts"))
    return FileLedger(spark, args.ledger)


def records_of(spark: SparkSession, args: argparse.Namespace, cfg: EngineConfig) -> DataFrame:
    if args.source == BROKER:
        return kafka.read_checkin_stream(spark, cfg)
    return kafka.raw_records(spark.readStream.schema(RAW_RECORD_DDL).parquet(args.source))


def job_of(spark: SparkSession, args: argparse.Namespace, cfg: EngineConfig, root: str) -> Job:
    ledger, on_error = ledger_of(spark, args, cfg), getattr(args, "on.error")
    if args.job == "ledger":
        return LedgerJob(spark, cfg, ledger, f"{root}/state", getattr(args, "on.missing"), on_error)
    sink = kafka_sink(cfg) if args.sink == BROKER else file_sink(args.sink)
    return LiveJob(spark, cfg, ledger, sink, f"{root}/state", on_error)


def main(argv: Sequence[str] | None = None) -> None:
    args = parse(argv)
    cfg = config_of(args)
    spark = SparkSession.builder.appName(name_of(args)).getOrCreate()
    tune(spark, streaming=True)
    if args.parallelism is not None:
        # Neither job keeps keyed state, so the cluster's width is as good.
        set_parallelism(spark, cfg)
    root = lasting_path(spark, name_of(args))
    job = job_of(spark, args, cfg, root)
    start(records_of(spark, args, cfg), job, f"{root}/checkpoint", getattr(args, "available.now")).awaitTermination()


if __name__ == "__main__":
    main()
