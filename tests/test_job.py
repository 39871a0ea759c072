import json

import pytest

from test_streaming import BATCHES, contents, new_ledger

from stampcard import EngineConfig, job
from stampcard.config import OPTION_FIELDS
from stampcard.job import config_of, name_of, parse
from stampcard.schemas import RAW_RECORD_DDL
from stampcard.session import job_path, lasting_path, remove_path, scratch_path, set_parallelism
from stampcard.sources import kafka
from stampcard.sources.database import DatabaseLedger
from stampcard.sources.tables import FileLedger
from stampcard.streaming.jobs import LedgerJob, LiveJob


def test_all_options_are_understood():
    text = {"checkpoint.interval": "1000", "parallelism": "8", "points.sequence": "1,2", "max.checkin.per.month": "3"}
    argv = [part for name in OPTION_FIELDS for part in (f"--{name}", text.get(name, "x"))]
    cfg = config_of(parse(argv))
    assert (cfg.kafka_bootstrap_servers, cfg.jdbc_url, cfg.points_ladder) == ("x", "x", (1, 2))
    assert (cfg.checkpoint_interval_ms, cfg.parallelism, cfg.max_per_month) == (1000, 8, 3)
    assert config_of(parse([])) == EngineConfig(id_mode="deterministic")


def test_bad_option_values_stop_the_start():
    with pytest.raises(ValueError):
        config_of(parse(["--points.sequence", "1,x"]))
    with pytest.raises(SystemExit):
        parse(["--no.such.option", "1"])


def test_kafka_options():
    cfg = EngineConfig(kafka_bootstrap_servers="b:1", kafka_topic="in", kafka_group_id="g", kafka_output_topic="out")
    assert kafka.source_options(cfg) == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "in",
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
        "kafka.group.id": "g",
    }
    bound = config_of(parse(["--max.offsets.per.trigger", "1000"]))
    assert kafka.source_options(bound)["maxOffsetsPerTrigger"] == "1000"
    assert kafka.sink_options(cfg) == {"kafka.bootstrap.servers": "b:1", "topic": "out"}


def test_arrival_order_of_records(spark):
    rows = [("k", "v", 1, 0), ("k", "v", 0, 5), ("k", "v", 0, 4_000_000_000)]
    df = spark.createDataFrame(rows, "key string, value string, partition int, offset bigint")
    seqs = [r.arrival_seq for r in kafka.raw_records(df).collect()]
    assert seqs == [1 << 48, 5, 4_000_000_000]


def test_shared_folder(spark):
    assert job_path(spark, "a") == job_path(spark, "a")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


class _Session:
    """A session that names no shared folder."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = self
        self.master = master


def test_only_a_local_session_may_lack_a_shared_folder():
    assert job_path(_Session("local[4]"), "a").endswith("/stampcard/a")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        job_path(_Session("yarn"), "a")


def test_parallelism_sets_the_shuffle_width(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    set_parallelism(spark, EngineConfig(parallelism=3))
    assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_the_command_needs_a_lasting_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lasting_path(_Session("local[4]"), "a")


def test_which_job_on_which_ledger(spark, tmp_path):
    for argv, kind, ledger, name in (
        ([], LiveJob, DatabaseLedger, "award-points"),
        (["--job", "ledger", "--ledger.parts", "3"], LedgerJob, DatabaseLedger, "keep-ledger"),
        (["--job", "ledger", "--ledger", "/x", "--job.name", "mine", "--on.missing", "quarantine"], LedgerJob, FileLedger, "mine"),
    ):
        args = parse(argv)
        made = job.job_of(spark, args, config_of(args), f"{tmp_path}/{name}")
        assert (type(made), type(made.ledger), name_of(args)) == (kind, ledger, name)
        assert getattr(made.ledger, "parts", 0) == (3 if "3" in argv else 8 if ledger is DatabaseLedger else 0)
        assert getattr(made, "on_missing", "fail") == ("quarantine" if name == "mine" else "fail")
    for bad in (["--job", "x"], ["--ledger.parts", "0"], ["--max.offsets.per.trigger", "-1"]):
        with pytest.raises(SystemExit):
            parse(bad)


def put(spark, folder, n):
    records = [
        (str(user), json.dumps({"eventId": event, "userId": user, "checkinDate": f"2024-01-{date:02}", "yearMonth": "2024-01"}), 0, n * 100 + k)
        for k, (event, user, date) in enumerate(BATCHES[n])
    ]
    spark.createDataFrame(records, RAW_RECORD_DDL).coalesce(1).write.mode("append").parquet(folder)


def test_both_commands_on_file_streams(spark, tmp_path, monkeypatch):
    ledger = new_ledger(spark, tmp_path)
    monkeypatch.setattr(job, "lasting_path", lambda _, name: f"{tmp_path}/{name}")
    common = ["--source", f"{tmp_path}/in", "--ledger", f"{tmp_path}/ledger", "--available.now", "--max.checkin.per.month", "2", "--points.sequence", "1,2"]
    for n in range(len(BATCHES)):
        put(spark, f"{tmp_path}/in", n)
        job.main([*common, "--sink", f"{tmp_path}/out"])
        job.main(["--job", "ledger", *common])
    daily, logged, total = contents(ledger)
    assert logged == ["a", "b", "c", "d", "e", "f", "g", "h"] and total[4] == 1
    sent = {(r.batch.rsplit("-", 1)[-1], r.user_id, r.event_id) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert {("0", 1, "a"), ("0", 1, "b"), ("0", 1, "d"), ("0", 2, "c")} <= sent
    assert ("1", 3, "a") not in sent and ("1", 4, "g") in sent


def test_remove_path(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/x")
    remove_path(spark, f"{tmp_path}/x")
    remove_path(spark, f"{tmp_path}/x")
    assert not (tmp_path / "x").exists()
