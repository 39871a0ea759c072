"""The ledger in a database: statements, their order, repeats and fences. The
database is a recorder that knows the few statements the ledger sends."""

import copy
import datetime as dt
import re

import pytest
from model import Checkin
from test_streaming import BATCHES, CFG, DAY, Clock, batch_of, day, expected_ledger, rows_of

from stampcard import EngineConfig
from stampcard.schemas import LEDGER_DDL, ledger_columns
from stampcard.sources import database as B
from stampcard.streaming.jobs import LedgerJob, LiveJob, file_sink

DATES = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))


class Unique(RuntimeError):
    pass


class Recorder:
    """Tables as lists of dicts. ``lose`` names what is to fail once."""

    def __init__(self, spark, users=range(5)):
        self.spark = spark
        self.tables = {name: [] for name in [*B.DATABASE_DDL, *LEDGER_DDL]}
        self.tables["users"] = [{"id": u, "total_points": 10, "updated_at": None} for u in users]
        self.log, self.queries, self.lose, self.twice = [], [], None, False

    def _fail(self, what):
        if self.lose == what:
            self.lose = None
            raise RuntimeError(f"lost at {what}")

    def append(self, table, rows):
        self.log.append(f"append {table}")
        found = [r.asDict() for r in rows.collect()]
        self.tables[table] += copy.deepcopy(found) * (1 + self.twice)
        self._fail(table)

    def _staged(self, table, values):
        rows = [r for r in self.tables[table] if (r["batch"], r["attempt"]) == values]
        return [dict(x) for x in {tuple(sorted(r.items(), key=lambda i: i[0])) for r in rows}]

    def _do(self, s):
        t = self.tables
        if m := re.fullmatch(r"DELETE FROM (\w+) WHERE batch = \?", s.sql):
            t[m[1]] = [r for r in t[m[1]] if r["batch"] != s.values[0]]
        elif s.sql.startswith("INSERT INTO applied_batches"):
            if any(r["batch"] == s.values[0] for r in t["applied_batches"]):
                raise Unique(s.values[0])
            t["applied_batches"].append({"batch": s.values[0]})
        elif s.sql.startswith("INSERT IGNORE INTO checkin_events"):
            have = {r["event_id"] for r in t["checkin_events"]}
            t["checkin_events"] += [r for r in self._staged("staged_checkin_events", s.values) if r["event_id"] not in have]
        else:
            rows = self._staged("staged_daily_checkin", s.values)
            if s.expect is not None:
                return len({r["user_id"] for r in rows} - {u["id"] for u in t["users"]})
            if s.sql.startswith("UPDATE users"):
                for user in t["users"]:
                    user["total_points"] += sum(r["points_earned"] for r in rows if r["user_id"] == user["id"])
            else:
                target = re.match(r"INSERT INTO (daily_checkin|user_points_history) ", s.sql)[1]
                t[target] += rows
        return None

    def transaction(self, statements):
        before = copy.deepcopy(self.tables)
        try:
            for s in statements:
                found = self._do(s)
                if s.expect is not None and found != s.expect:
                    raise B.LedgerConflict(s.sql)
            self._fail("commit")
        except BaseException:
            self.tables = before
            raise
        self.log += [re.match(r"\w+( IGNORE)?( INTO| FROM)? \S+", s.sql)[0] for s in statements]
        self._fail("answer")

    def number(self, query, values):
        assert "applied_batches" in query
        return sum(r["batch"] == values[0] for r in self.tables["applied_batches"])

    def read(self, query, parts):
        self.queries.append(query)
        attempt = re.search(r"batch = '([^']+)' AND attempt = '([^']+)'", query).groups()
        name = re.search(r"FROM (lookup_\w+)", query)[1]
        key = {"lookup_users": "user_id", "lookup_events": "event_id"}[name]
        keys = {r[key] for r in self.tables[name] if (r["batch"], r["attempt"]) == attempt}
        if "JOIN users" in query:
            return self.spark.createDataFrame([(u["id"], 0) for u in self.tables["users"] if u["id"] in keys], "id bigint, part int")
        if "JOIN checkin_events" in query:
            rows = [(r["event_id"], 0) for r in self.tables["checkin_events"] if r["event_id"] in keys]
            return self.spark.createDataFrame(rows, "event_id string, part int")
        low, high = (dt.date.fromisoformat(d) for d in re.findall(r"DATE '([^']+)'", query))
        names = ledger_columns("daily_checkin")
        rows = [
            (*[r[n] for n in names], 0)
            for r in self.tables["daily_checkin"]
            if r["user_id"] in keys and low <= r["checkin_date"] <= high
        ]
        return self.spark.createDataFrame(rows, LEDGER_DDL["daily_checkin"] + ", part int")

    def contents(self):
        daily = sorted((r["user_id"], r["checkin_date"]) for r in self.tables["daily_checkin"])
        logged = sorted(r["event_id"] for r in self.tables["checkin_events"])
        total = {u["id"]: u["total_points"] - 10 for u in self.tables["users"] if u["total_points"] != 10}
        return daily, logged, total


APPLY = [
    "INSERT INTO applied_batches", "SELECT COUNT(*)", "UPDATE users", "INSERT INTO daily_checkin",
    "INSERT INTO user_points_history", "INSERT IGNORE INTO checkin_events",
    "DELETE FROM staged_daily_checkin", "DELETE FROM staged_checkin_events",
]


def ledger_job(spark, root, db, cfg=CFG, **more):
    return LedgerJob(spark, cfg, B.DatabaseLedger(db, 4), f"{root}/state", clock=Clock(day(0)), **more)


@pytest.mark.parametrize("mode", ["snapshot", "sequential"])
def test_batches_applied_to_a_database_equal_the_fold(spark, tmp_path, mode):
    db, cfg = Recorder(spark), CFG.with_(order_mode=mode)
    db.twice = True  # as if every writing task had run twice
    for n in range(len(BATCHES)):
        ledger_job(spark, tmp_path, db, cfg).run(rows_of(spark, batch_of(n)), f"q-{n}")
    assert db.contents() == expected_ledger(cfg)
    assert len(db.tables["user_points_history"]) == len(db.tables["daily_checkin"])
    first = db.log[: db.log.index("DELETE FROM staged_checkin_events") + 1]
    assert first == ["append lookup_users", "append lookup_events", "append staged_daily_checkin", "append staged_checkin_events", *APPLY]
    for name in B.DATABASE_DDL:
        assert db.tables[name] == [] or name == "applied_batches"


@pytest.mark.parametrize("lost", ["lookup_events", "staged_daily_checkin", "staged_checkin_events", "commit", "answer"])
def test_a_batch_that_breaks_off_is_applied_once(spark, tmp_path, lost):
    db = Recorder(spark)
    db.lose = lost
    job = ledger_job(spark, tmp_path, db)
    with pytest.raises(RuntimeError, match="lost"):
        job.run(rows_of(spark, batch_of(0)), "q-0")
    job.run(rows_of(spark, batch_of(0)), "q-0")
    job.run(rows_of(spark, batch_of(0)), "q-0")
    job.run(rows_of(spark, batch_of(1)), "q-1")
    assert db.contents() == expected_ledger(CFG)


def test_of_two_attempts_at_once_one_is_applied(spark, tmp_path):
    db = Recorder(spark)
    late, job = ledger_job(spark, f"{tmp_path}/a", db), ledger_job(spark, f"{tmp_path}/b", db)
    plain = late.ledger.has
    calls = []

    def overtaken(batch):
        found = plain(batch)
        calls.append(batch)
        if len(calls) == 2:  # after its decisions, before its changes
            job.run(rows_of(spark, batch_of(0)), "q-0")
        return found

    late.ledger.has = overtaken
    with pytest.raises(Unique):
        late.run(rows_of(spark, batch_of(0)), "q-0")
    job.run(rows_of(spark, batch_of(1)), "q-1")
    assert db.contents() == expected_ledger(CFG)


def test_a_user_removed_meanwhile_stops_the_batch(spark, tmp_path):
    db = Recorder(spark)
    known = B.DatabaseLedger.known_users

    class Ledger(B.DatabaseLedger):
        def known_users(self, checkins, batch):
            found = known(self, checkins, batch)
            db.tables["users"] = db.tables["users"][2:]
            return found

    job = LedgerJob(spark, CFG, Ledger(db), f"{tmp_path}/state", clock=Clock(day(0)))
    with pytest.raises(B.LedgerConflict):
        job.run(rows_of(spark, batch_of(0)), "q-0")
    assert db.contents() == ([], [], {}) and db.tables["applied_batches"] == []


def test_the_live_job_asks_for_its_keys_only(spark, tmp_path):
    db = Recorder(spark)
    db.tables["checkin_events"] = [{"event_id": "old"}, {"event_id": "other"}]
    job = LiveJob(spark, CFG, B.DatabaseLedger(db), file_sink(f"{tmp_path}/out"), f"{tmp_path}/state", clock=Clock(day(0)))
    job.run(rows_of(spark, [Checkin("a", 1, DAY, 1), Checkin("old", 1, DAY, 2)]), "q-0")
    assert [r.event_id for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["a"]
    assert len(db.queries) == 2 and db.tables["lookup_users"] == db.tables["lookup_events"] == []
    job.run(rows_of(spark, []), "q-1")
    assert len(db.queries) == 2


def test_every_query_is_bound_to_a_batch():
    for query in (B.logged_query("q-1", "t"), B.daily_query("q-1", "t", DATES), B.users_query("q-1", "t")):
        assert "WHERE batch = 'q-1' AND attempt = 't'" in query and " JOIN " in query
    assert "BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'" in B.daily_query("q-1", "t", DATES)
    for statement in B.apply_statements("q-1", "t"):
        assert statement.values[0] == "q-1"
        assert statement.sql.count("?") == len(statement.values)
    with pytest.raises(ValueError):
        B.logged_query("x'; --", "t")


def test_options():
    cfg = EngineConfig(jdbc_url="u", jdbc_username="n", jdbc_password="p")
    plain = {"url": "u", "user": "n", "password": "p", "fetchsize": "10000", "useCursorFetch": "true"}
    assert B.jdbc_options(cfg) == plain
    assert B.read_options(cfg, "SELECT 1 AS part", 8) == plain | {
        "dbtable": "(SELECT 1 AS part) batch_rows", "partitionColumn": "part",
        "lowerBound": "0", "upperBound": "8", "numPartitions": "8",
    }


class Connection:
    """What the driver's connection is asked for, in order."""

    def __init__(self, answers=(), fail=None):
        self.calls, self.answers, self.fail = [], list(answers), fail

    def __getattr__(self, name):
        def call(*values):
            self.calls.append((name, *values))
            if values and values[0] == self.fail:
                raise RuntimeError(self.fail)
            return self.answers.pop(0) if name == "getLong" else self

        return call


def test_a_transaction_is_committed_or_rolled_back():
    statements = [B.Statement("one ?", ("x",)), B.Statement("count", expect=0), B.Statement("two")]
    good, bad, broken = Connection([0]), Connection([3]), Connection([0], fail="two")
    for connection, error in ((good, None), (bad, B.LedgerConflict), (broken, RuntimeError)):
        database = B.JdbcDatabase(None, CFG, lambda c=connection: c)
        if error is None:
            database.transaction(statements)
        else:
            with pytest.raises(error):
                database.transaction(statements)
        names = [c[0] for c in connection.calls]
        assert names[0] == "setAutoCommit" and names[-1] == "close"
        assert ("commit" in names, "rollback" in names) == (error is None, error is not None)
    assert ("setObject", 1, "x") in good.calls
    assert [c[1] for c in good.calls if c[0] == "prepareStatement"] == ["one ?", "count", "two"]
    assert B.JdbcDatabase(None, CFG, lambda: Connection([7])).number("q", ("v",)) == 7
