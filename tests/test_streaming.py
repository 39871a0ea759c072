import datetime as dt
import json
import re
import time

import model
import pytest
from model import Checkin
from test_ledger import USERS

from stampcard import EngineConfig
from stampcard.schemas import LEDGER_DDL, RAW_RECORD_DDL
from stampcard.sources import kafka
from stampcard.sources.tables import USER_POINTS_DDL, FileLedger
from stampcard.streaming.dedup_state import dedup_stream, keep_first_copies
from stampcard.streaming.jobs import (
    LedgerJob,
    LiveJob,
    apply_ledger_stream,
    file_sink,
    start_live_stream,
)

DAY = dt.date(2024, 1, 5)
CFG = EngineConfig(max_per_month=2, points_ladder=(1, 2), id_mode="deterministic")
KEYS = "user_id bigint, event_id string, arrival_seq bigint"


def rows_of(spark, checkins):
    return spark.createDataFrame([c.row() for c in checkins], model.SCHEMA)


def new_ledger(spark, root, users=range(5), daily=(), logged=()):
    days = [(u, d, 1, 1, None) for u, d in daily]
    events = [(e, 0, DAY, None, "2024-01", 0, True, None, None, None, None) for e in logged]
    return FileLedger(spark, f"{root}/ledger").create(
        spark.createDataFrame([(u, 10, None) for u in users], USERS),
        spark.createDataFrame(days, LEDGER_DDL["daily_checkin"]),
        spark.createDataFrame(events, LEDGER_DDL["checkin_events"]),
    )


def book(spark, ledger, days, batch, enter=True):
    """Somebody else adds daily rows to the ledger."""
    rows = spark.createDataFrame([(u, d, 1, 1, None) for u, d in days], LEDGER_DDL["daily_checkin"])
    ledger._write("daily_checkin", rows, batch)
    for table in ("checkin_events", "user_points_history"):
        ledger._write(table, spark.createDataFrame([], LEDGER_DDL[table]), batch)
    ledger._write("user_points", spark.createDataFrame([(1, 5, None)], USER_POINTS_DDL), batch)
    if enter:
        ledger._enter(batch)


class Clock:
    def __init__(self, *times):
        self.times = list(times)

    def __call__(self):
        return self.times.pop(0) if len(self.times) > 1 else self.times[0]


def day(n, hour=0):
    return dt.datetime(2024, 3, 1) + dt.timedelta(days=n, hours=hour)


# --- state with a time to live -------------------------------------------


def run_dedup(spark, root, ttl_ms=3_600_000):
    stream = spark.readStream.schema(KEYS).parquet(f"{root}/in")
    query = (
        dedup_stream(stream, ttl_ms)
        .writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)
    return sorted(tuple(r) for r in spark.read.schema(KEYS).parquet(f"{root}/out").collect())


def add(spark, root, rows):
    spark.createDataFrame(rows, KEYS).write.mode("append").parquet(f"{root}/in")


def test_state_dedup_survives_a_restart(spark, tmp_path):
    add(spark, tmp_path, [(1, "a", 5), (1, "a", 3), (2, "a", 9), (1, "b", 7)])
    assert run_dedup(spark, tmp_path) == [(1, "a", 3), (1, "b", 7), (2, "a", 9)]
    add(spark, tmp_path, [(1, "a", 20), (1, "c", 21)])
    assert run_dedup(spark, tmp_path) == [(1, "a", 3), (1, "b", 7), (1, "c", 21), (2, "a", 9)]


def test_state_is_forgotten_after_its_time(spark, tmp_path):
    add(spark, tmp_path, [(1, "a", 1)])
    run_dedup(spark, tmp_path, ttl_ms=1000)
    time.sleep(2)
    add(spark, tmp_path, [(1, "a", 2)])
    assert run_dedup(spark, tmp_path, ttl_ms=1000) == [(1, "a", 1), (1, "a", 2)]


def test_stream_copies_at_days_0_5_and_10(spark, tmp_path):
    """Accepted, duplicate without renewal, accepted again; by a given clock."""
    schema = f"{KEYS}, now_ms bigint"
    for n, days in enumerate((0, 5, 10)):
        rows = [(1, "a", 10 * n + 1, days * 86_400_000), (1, "a", 10 * n, days * 86_400_000), (n, "b", n, days * 86_400_000)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        query = (
            dedup_stream(stream, 7 * 86_400_000, clock_col="now_ms", buckets=2)
            .writeStream.format("parquet")
            .option("path", f"{tmp_path}/out")
            .option("checkpointLocation", f"{tmp_path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        assert query.awaitTermination(120)
    got = sorted((r.event_id, r.user_id, r.arrival_seq) for r in spark.read.schema(KEYS).parquet(f"{tmp_path}/out").collect())
    assert got == [("a", 1, 0), ("a", 1, 20), ("b", 0, 0), ("b", 1, 1), ("b", 2, 2)]


def test_rows_that_do_not_mark_are_not_remembered(spark, tmp_path):
    schema = KEYS + ", marks boolean"
    rows = [(1, "a", 1, False), (1, "a", 2, True), (1, "a", 3, True)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    query = (
        dedup_stream(stream, 1000, marks_col="marks")
        .writeStream.format("memory")
        .queryName("marks_only")
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)
    assert [tuple(r) for r in spark.table("marks_only").collect()] == [(1, "a", 2)]


def test_copies_are_thinned_before_the_shuffle(spark):
    copies = spark.range(50_000).selectExpr(
        "1L AS user_id", "'a' AS event_id", "50000 - id AS arrival_seq"
    )
    kept = [r.arrival_seq for r in keep_first_copies(copies.coalesce(2)).collect()]
    assert min(kept) == 1 and len(kept) < 20


# --- live job --------------------------------------------------------------


def live_job(spark, root, ledger, clock, sink=None, cfg=CFG, on_error=None):
    return LiveJob(spark, cfg, ledger, sink or file_sink(f"{root}/out"), f"{root}/state", on_error, clock)


def sent(spark, root):
    out = spark.read.parquet(f"{root}/out")
    return sorted((r.batch.rsplit("-", 1)[-1], r.event_id, r.checkin_order) for r in out.collect())


def test_copies_at_days_0_5_and_10(spark, tmp_path):
    """The copy of day 5 is a duplicate and does not renew the memory."""
    job = live_job(spark, tmp_path, new_ledger(spark, tmp_path), Clock(day(0), day(5), day(10)))
    for n in range(3):
        job.run(rows_of(spark, [Checkin("a", 1, DAY, n)]), f"q-{n}")
    assert sent(spark, tmp_path) == [("0", "a", 1), ("2", "a", 1)]


def test_days_that_are_over_are_merged_and_old_ones_removed(spark, tmp_path):
    ledger = new_ledger(spark, tmp_path)
    times = [day(0, 1), day(0, 5), day(0, 9), day(1), day(2), day(6), day(9)]
    job = live_job(spark, tmp_path, ledger, Clock(*times), cfg=CFG.with_(max_per_month=50))
    for n, events in enumerate(["ab", "bc", "ad", "abcde", "e", "abe", "ae"]):
        job.run(rows_of(spark, [Checkin(e, 1, DAY, 10 * n + k) for k, e in enumerate(events)]), f"q-{n}")
    passed = {}
    for batch, event, _ in sent(spark, tmp_path):
        passed.setdefault(batch, []).append(event)
    # On day 9 the marks of day 0 have expired, that of day 1 has expired too.
    assert passed == {"0": ["a", "b"], "1": ["c"], "2": ["d"], "3": ["e"], "6": ["a", "e"]}
    folders = lambda path: sorted(p.name for p in path.iterdir() if p.name.startswith("day="))
    assert folders(tmp_path / "state/seen") == ["day=1970-01-01", "day=2024-03-10"]
    assert set(folders(tmp_path / "state/seen/merged")) <= {"day=1970-01-01", "day=2024-03-03", "day=2024-03-07"}


def test_a_small_batch_reads_few_files_of_the_memory(spark, tmp_path):
    cfg = CFG.with_(max_per_month=10_000)
    job = live_job(spark, tmp_path, new_ledger(spark, tmp_path), Clock(day(0), day(1)), cfg=cfg)
    job.run(rows_of(spark, [Checkin(f"e{k}", k % 5, DAY, k) for k in range(600)]), "q-0")
    job.run(rows_of(spark, [Checkin("x", 1, DAY, 9000)]), "q-1")
    merged = tmp_path / "state/seen/merged/day=2024-03-01"
    assert len(list(merged.glob("bucket=*/*.parquet"))) == 64
    again = rows_of(spark, [Checkin("e7", 2, DAY, 1), Checkin("e8", 3, DAY, 2), Checkin("new", 1, DAY, 3)])
    seen = job.seen.read("q-2", day(2), again)
    assert sorted(r.event_id for r in seen.collect()) == ["e7", "e8"]
    plan = seen._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(", plan)


def test_quota_reject_may_come_again(spark, tmp_path):
    full = [(1, dt.date(2024, 1, d)) for d in (1, 2)]
    job = live_job(spark, tmp_path, new_ledger(spark, tmp_path, daily=full), Clock(day(0)))
    job.run(rows_of(spark, [Checkin("a", 1, DAY, 1)]), "q-0")
    job.run(rows_of(spark, [Checkin("a", 1, dt.date(2024, 2, 1), 2)]), "q-1")
    job.run(rows_of(spark, [Checkin("a", 1, dt.date(2024, 2, 2), 3)]), "q-2")
    assert sent(spark, tmp_path) == [("1", "a", 1)]


def test_repeated_batch_sends_the_same(spark, tmp_path):
    calls = []

    def failing_sink(transactions, batch):
        calls.append(sorted(tuple(r) for r in transactions.drop("metadata").collect()))
        if len(calls) == 1:
            raise RuntimeError("lost")

    clock = Clock(day(0), day(1))
    cfg = CFG.with_(id_mode="reference")
    ledger = new_ledger(spark, tmp_path)
    job = live_job(spark, tmp_path, ledger, clock, failing_sink, cfg)
    batch = rows_of(spark, [Checkin("a", 1, DAY, 1), Checkin("a", 1, DAY, 2), Checkin("b", 2, DAY, 3)])
    with pytest.raises(RuntimeError):
        job.run(batch, "q-0")
    # Meanwhile somebody books what was sent.
    book(spark, ledger, [(1, DAY)], "other")
    job.run(batch, "q-0")
    job.run(batch, "q-0")
    assert len(calls) == 2 and calls[0] == calls[1] and len(calls[0]) == 2


def test_ledger_is_read_anew_for_every_batch(spark, tmp_path):
    ledger = new_ledger(spark, tmp_path)
    job = live_job(spark, tmp_path, ledger, Clock(day(0)))
    job.run(rows_of(spark, [Checkin("a", 1, DAY, 1)]), "q-0")
    book(spark, ledger, [(1, DAY)], "other")
    job.run(rows_of(spark, [Checkin("b", 1, DAY, 2)]), "q-1")
    assert sent(spark, tmp_path) == [("0", "a", 1), ("1", "b", 2)]


def test_raw_stream_with_restart(spark, tmp_path):
    """Raw records from files, one file per batch; state carries over."""
    ledger = new_ledger(spark, tmp_path, daily=[(1, dt.date(2024, 1, 1))], logged=["old"])
    events = [
        [("a", 1), ("a", 1), ("old", 1), ("b", 2)],
        [("a", 1), ("c", 1), ("a", 2)],
    ]

    def put(n):
        records = []
        for k, (event, user) in enumerate(events[n]):
            value = json.dumps({"eventId": event, "userId": user, "checkinDate": "2024-01-05", "yearMonth": "2024-01"})
            records.append((str(user), value, 0, n * 10 + k))
        records.append((None, "{bad", 1, n))
        frame = spark.createDataFrame(records, RAW_RECORD_DDL)
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        raw = spark.readStream.schema(RAW_RECORD_DDL).parquet(f"{tmp_path}/in")
        job = live_job(spark, tmp_path, ledger, Clock(day(0)), on_error="quarantine")
        query = start_live_stream(kafka.raw_records(raw), job, f"{tmp_path}/checkpoint", True)
        assert query.awaitTermination(180)

    put(0)
    run()
    assert sent(spark, tmp_path) == [("0", "a", 2), ("0", "b", 1)]
    put(1)
    run()
    assert sent(spark, tmp_path) == [("0", "a", 2), ("0", "b", 1), ("1", "a", 1), ("1", "c", 2)]
    bad = spark.read.parquet(f"{tmp_path}/state/quarantine").collect()
    assert [(r.raw, r.reason) for r in bad] == [("{bad", "MALFORMED")] * 2


def test_bad_record_stops_the_stream(spark, tmp_path):
    spark.createDataFrame([(None, "{bad", 0, 1)], RAW_RECORD_DDL).write.parquet(f"{tmp_path}/in")
    raw = spark.readStream.schema(RAW_RECORD_DDL).parquet(f"{tmp_path}/in")
    job = live_job(spark, tmp_path, new_ledger(spark, tmp_path), Clock(day(0)), on_error="fail")
    query = start_live_stream(kafka.raw_records(raw), job, f"{tmp_path}/checkpoint", True)
    with pytest.raises(Exception, match="unusable check-in record"):
        query.awaitTermination(120)


# --- ledger job ------------------------------------------------------------

BATCHES = [
    [("a", 1, 1), ("a", 1, 1), ("b", 1, 1), ("c", 2, 1), ("d", 1, 2)],
    [("a", 1, 3), ("e", 1, 3), ("f", 2, 1), ("a", 3, 1), ("g", 4, 9), ("h", 4, 9)],
]


def batch_of(n):
    return [
        Checkin(event, user, dt.date(2024, 1, date), n * 100 + k)
        for k, (event, user, date) in enumerate(BATCHES[n])
    ]


def expected_ledger(cfg):
    daily, logged, total = [], set(), {}
    for n in range(len(BATCHES)):
        checkins = batch_of(n)
        decisions = model.decide(checkins, daily, logged, cfg)
        rows, log, added = model.apply(checkins, decisions, daily, logged, cfg)
        daily += [(u, d) for u, d, _, _ in rows]
        logged |= set(log)
        for user, earned in added.items():
            total[user] = total.get(user, 0) + earned
    return sorted(daily), sorted(logged), total


def contents(ledger):
    daily = sorted((r.user_id, r.checkin_date) for r in ledger.daily_checkin().collect())
    logged = sorted(r.event_id for r in ledger.checkin_events().collect())
    total = {r.id: r.total_points - 10 for r in ledger.users().collect() if r.total_points != 10}
    return daily, logged, total


@pytest.mark.parametrize("mode", ["snapshot", "sequential"])
def test_ledger_stream_equals_the_fold(spark, tmp_path, mode):
    cfg = CFG.with_(order_mode=mode)
    ledger = new_ledger(spark, tmp_path)
    for n in range(len(BATCHES)):
        rows_of(spark, batch_of(n)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        job = LedgerJob(spark, cfg, ledger, f"{tmp_path}/state", clock=Clock(day(n)))
        stream = spark.readStream.schema(model.SCHEMA).parquet(f"{tmp_path}/in")
        query = apply_ledger_stream(stream, job, f"{tmp_path}/checkpoint", True)
        assert query.awaitTermination(180)
    assert contents(ledger) == expected_ledger(cfg)
    assert ledger.user_points_history().count() == len(expected_ledger(cfg)[0])
    assert contents(ledger.rebase(f"{tmp_path}/later")) == contents(ledger)


def test_repeated_ledger_batch_changes_nothing(spark, tmp_path):
    ledger = new_ledger(spark, tmp_path)
    job = LedgerJob(spark, CFG, ledger, f"{tmp_path}/state", clock=Clock(day(0), day(1)))
    note = job.journal.note

    def lost(batch, step, at):
        if step == "finished":
            raise RuntimeError("lost")
        note(batch, step, at)

    job.journal.note = lost
    with pytest.raises(RuntimeError):
        job.run(rows_of(spark, batch_of(0)), "q-0")
    before = contents(ledger)
    job.journal.note = note
    job.run(rows_of(spark, batch_of(0)), "q-0")
    assert contents(ledger) == before
    job.run(rows_of(spark, batch_of(1)), "q-1")
    assert contents(ledger) == expected_ledger(CFG)


def test_a_half_written_batch_is_not_seen(spark, tmp_path):
    ledger = new_ledger(spark, tmp_path)
    book(spark, ledger, [(1, DAY)], "q-0", enter=False)
    assert contents(ledger) == ([], [], {}) and not ledger.has("q-0")
    job = LedgerJob(spark, CFG, ledger, f"{tmp_path}/state", clock=Clock(day(0)))
    job.run(rows_of(spark, batch_of(0)), "q-0")
    job.run(rows_of(spark, batch_of(1)), "q-1")
    assert contents(ledger) == expected_ledger(CFG)


def test_a_pinned_ledger_is_of_one_moment(spark, tmp_path):
    ledger = new_ledger(spark, tmp_path)
    book(spark, ledger, [(1, DAY)], "q-0")
    view = ledger.pinned()
    book(spark, ledger, [(2, DAY)], "q-1")
    assert contents(view) == ([(1, DAY)], [], {1: 5})
    assert contents(ledger) == ([(1, DAY), (2, DAY)], [], {1: 10})


def test_batches_before_during_and_after_merging(spark, tmp_path):
    plain, merged = (new_ledger(spark, f"{tmp_path}/{name}", users=range(40)) for name in ("plain", "merged"))
    jobs = [
        LedgerJob(spark, CFG, ledger, f"{tmp_path}/{n}/state", clock=Clock(day(0)), merge_every=every)
        for n, (ledger, every) in enumerate(((plain, 1000), (merged, 2)))
    ]
    for n in range(6):
        batch = [Checkin(f"{n % 4}-{k}", k % 7, dt.date(2024, 1 + n % 3, 1 + k % 5), n * 100 + k) for k in range(12)]
        for job in jobs:
            job.run(rows_of(spark, batch), f"q-{n}")
            job.run(rows_of(spark, batch), f"q-{n}")
        assert contents(merged) == contents(plain)
    assert len(plain.batches()) == 7 and len(merged.batches()) <= 4
    folders = {p.name for p in (tmp_path / "merged/ledger/checkin_events").iterdir() if p.is_dir()}
    assert len(folders) <= 7
    assert all(merged.has(f"q-{n}") for n in range(6)) and not merged.has("q-6") and not merged.has("r-0")
    # A reader that began before a merging goes on reading what it found.
    view, before = merged.pinned(), contents(merged)
    merged.merge_batches(2)
    assert contents(view) == before == contents(merged)


def test_notes_of_batches_long_done_are_removed(spark, tmp_path):
    job = live_job(spark, tmp_path, new_ledger(spark, tmp_path), Clock(day(0)))
    for n in (0, 1, 8):
        job.run(rows_of(spark, []), f"q-{n}")
    assert job.journal.time_of("q-0", "finished") is None
    assert job.journal.time_of("q-1", "finished") == day(0)


def test_a_sink_gets_a_users_records_by_arrival(spark, tmp_path):
    seen = []

    def sink(transactions, batch):
        parts = transactions.select("user_id", "event_id").rdd.glom().collect()
        seen.append([[tuple(r) for r in p] for p in parts if p])

    cfg = CFG.with_(max_per_month=100)
    job = live_job(spark, tmp_path, new_ledger(spark, tmp_path), Clock(day(0)), sink, cfg)
    checkins = [Checkin(f"{k:03}", k % 5, DAY, 1000 - k) for k in range(200)]
    job.run(rows_of(spark, checkins).repartition(7), "q-0")
    assert len(seen) == 1
    by_user_id = {}
    for part in seen[0]:
        for user, event in part:
            by_user_id.setdefault(user, []).append((id(part), event))
    for rows in by_user_id.values():
        assert len({p for p, _ in rows}) == 1
        assert [e for _, e in rows] == sorted((e for _, e in rows), reverse=True)
    assert sum(map(len, by_user_id.values())) == 200


def test_unknown_users_are_put_aside(spark, tmp_path):
    ledger = new_ledger(spark, tmp_path, users=[1])
    job = LedgerJob(spark, CFG, ledger, f"{tmp_path}/state", "quarantine", clock=Clock(day(0)))
    job.run(rows_of(spark, batch_of(0)), "q-0")
    assert contents(ledger)[1] == ["a", "b", "d"]
    aside = spark.read.parquet(f"{tmp_path}/state/unknown_users").collect()
    assert [r.event_id for r in aside] == ["c"]


def test_outcomes_are_logged(spark, tmp_path, caplog):
    ledger = new_ledger(spark, tmp_path, daily=[(1, dt.date(2024, 1, d)) for d in (1, 2)], logged=["old"])
    events = [("a", 1), ("b", 2), ("b", 2), ("old", 2)]
    checkins = [Checkin(e, u, DAY, k) for k, (e, u) in enumerate(events)]
    counts = "{'ACCEPT': 1, 'DUP_STATE': 1, 'DUP_LEDGER': 1, 'LIMIT': 1}"
    with caplog.at_level("INFO"):
        live_job(spark, f"{tmp_path}/live", ledger, Clock(day(0))).run(rows_of(spark, checkins), "q-0")
        assert counts in caplog.text
        caplog.clear()
        LedgerJob(spark, CFG, ledger, f"{tmp_path}/state", clock=Clock(day(0))).run(rows_of(spark, checkins), "q-0")
        assert counts in caplog.text


def test_empty_batch(spark, tmp_path):
    ledger = new_ledger(spark, tmp_path)
    LedgerJob(spark, CFG, ledger, f"{tmp_path}/state", clock=Clock(day(0))).run(rows_of(spark, []), "q-0")
    live_job(spark, f"{tmp_path}/live", ledger, Clock(day(0))).run(rows_of(spark, []), "q-0")
    assert contents(ledger) == ([], [], {})
