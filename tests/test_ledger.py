import datetime as dt

import model
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from model import Checkin
from pyspark.sql import functions as F
from test_decide import CONFIGS, frames, world

from stampcard.operators.ledger import UnknownUserError, apply_ledger, log_only, user_balances
from stampcard.plans.pipelines import audit_checkins



def now():
    return F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")


USERS = "id bigint, total_points bigint, updated_at timestamp_ntz"


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(world, min_size=15, max_size=25))
def test_tables_equal_the_row_by_row_sink(spark, worlds):
    checkins, daily, logged = [], [], []
    for w, (events, days, ids, _) in enumerate(worlds):
        for k, (event, user, date) in enumerate(events):
            checkins.append(Checkin(f"{w}-{event}", w * 10 + user, date, w * 1000 + k))
        daily += [(w * 10 + user, date) for user, date in days]
        logged += [f"{w}-{event}" for event in ids]
    inputs = frames(spark, checkins, daily, logged)
    users = spark.createDataFrame([(i, 100, None) for i in range(len(worlds) * 10)], USERS)
    for cfg in CONFIGS:
        decisions = model.decide(checkins, daily, set(logged), cfg)
        rows, log, added = model.apply(checkins, decisions, daily, set(logged), cfg)
        processed = audit_checkins(*inputs, cfg)
        changes = apply_ledger(processed, users, inputs[1], inputs[2], now())
        days = [(r.user_id, r.checkin_date, r.points_earned, r.checkin_order)
                for r in changes.daily_checkin.collect()]
        assert sorted(days) == sorted(rows)
        history = [(r.user_id, r.points, r.description) for r in changes.user_points_history.collect()]
        assert sorted(history) == sorted(
            (u, p, f"Daily check-in #{o} (event-driven)") for u, _, p, o in rows
        )
        written = {r.event_id: (r.user_id, r.processed) for r in changes.checkin_events.collect()}
        assert written == {e: (u, done) for e, (u, done, _) in log.items()}
        balances = user_balances(users, changes.user_points, now()).collect()
        assert {r.id: r.total_points - 100 for r in balances if r.updated_at} == added
        assert len(balances) == len(worlds) * 10


DAY = dt.date(2024, 1, 5)


def changes_of(spark, checkins, users, on_missing="fail", daily=(), logged=()):
    inputs = frames(spark, checkins, daily, logged)
    processed = audit_checkins(*inputs, CONFIGS[0])
    known = spark.createDataFrame([(u, 0, None) for u in users], USERS)
    return apply_ledger(processed, known, inputs[1], inputs[2], now(), on_missing)


def test_unknown_user_fails_before_writing(spark):
    with pytest.raises(UnknownUserError, match="2"):
        changes_of(spark, [Checkin("a", 1, DAY, 1), Checkin("b", 2, DAY, 2)], [1])


def test_unknown_user_of_a_taken_day_is_only_logged(spark):
    changes = changes_of(spark, [Checkin("b", 2, DAY, 2)], [1], daily=[(2, DAY)])
    log = changes.checkin_events.head()
    assert (log.event_id, log.processed, log.points_earned, log.error_message) == ("b", False, 2, None)


def test_unknown_user_is_put_aside_whole(spark):
    rows = [Checkin("a", 1, DAY, 1), Checkin("b", 2, DAY, 2), Checkin("c", 2, DAY, 3)]
    changes = changes_of(spark, rows, [1], "quarantine")
    assert {r.event_id for r in changes.unknown_user_rows.collect()} == {"b", "c"}
    assert [r.event_id for r in changes.checkin_events.collect()] == ["a"]
    assert [r.user_id for r in changes.user_points.collect()] == [1]


def test_same_day_loser_keeps_its_points_in_the_log(spark):
    rows = [Checkin("a", 1, DAY, 1), Checkin("b", 1, DAY, 2)]
    log = {r.event_id: r for r in changes_of(spark, rows, [1]).checkin_events.collect()}
    assert (log["a"].processed, log["b"].processed) == (True, False)
    assert (log["b"].points_earned, log["b"].error_message, log["b"].processed_at) == (1, None, None)


def test_quota_reject_is_logged_so_its_retry_is_a_ledger_duplicate(spark):
    full = [(1, dt.date(2024, 1, d)) for d in (1, 2)]
    first = changes_of(spark, [Checkin("a", 1, DAY, 1)], [1], daily=full)
    log = [r.event_id for r in first.checkin_events.collect()]
    assert log == ["a"]
    retry = audit_checkins(
        *frames(spark, [Checkin("a", 1, dt.date(2024, 2, 5), 9)], full, log), CONFIGS[0]
    )
    assert retry.head().duplicate


def test_log_only_rows(spark):
    inputs = frames(spark, [Checkin("a", 1, DAY, 1), Checkin("a", 1, DAY, 2)], [], [])
    assert [r.arrival_seq for r in log_only(audit_checkins(*inputs, CONFIGS[0])).collect()] == [2]


def test_unknown_policy_is_refused(spark):
    with pytest.raises(ValueError):
        changes_of(spark, [Checkin("a", 1, DAY, 1)], [1], "ignore")
