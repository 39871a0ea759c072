"""The set form of the rule against the rule itself, event by event."""

import datetime as dt

import model
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from model import Checkin

from stampcard import EngineConfig
from stampcard.operators.decide import accept, decide

DATES = [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 2), dt.date(2025, 1, 31)]
CONFIGS = [
    EngineConfig(max_per_month=2, points_ladder=(1, 2), order_mode=mode)
    for mode in ("snapshot", "sequential")
]

stream = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 2), st.sampled_from(DATES)), min_size=1, max_size=30
)
world = st.tuples(
    stream,
    st.sets(st.tuples(st.integers(0, 2), st.sampled_from(DATES)), max_size=5),
    st.sets(st.integers(0, 4), max_size=2),
    st.sets(st.tuples(st.integers(0, 2), st.integers(0, 4)), max_size=2),
)


def frames(spark, checkins, daily, logged):
    return (
        spark.createDataFrame([c.row() for c in checkins], model.SCHEMA),
        spark.createDataFrame(list(daily), "user_id bigint, checkin_date date"),
        spark.createDataFrame([(e,) for e in logged], "event_id string"),
    )


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(world, min_size=20, max_size=40))
def test_set_form_equals_the_fold(spark, worlds):
    """Many small worlds are decided in one job, each with ids of its own."""
    checkins, daily, logged, seen = [], [], [], []
    for w, (events, days, ids, marks) in enumerate(worlds):
        for k, (event, user, date) in enumerate(events):
            checkins.append(Checkin(f"{w}-{event}", w * 10 + user, date, w * 1000 + k))
        daily += [(w * 10 + user, date) for user, date in days]
        logged += [f"{w}-{event}" for event in ids]
        seen += [(w * 10 + user, f"{w}-{event}") for user, event in marks]
    inputs = frames(spark, checkins, daily, logged)
    marked = spark.createDataFrame(seen, "user_id bigint, event_id string")
    for cfg in CONFIGS:
        expected = model.decide(checkins, daily, set(logged), cfg)
        rows = decide(*inputs, cfg).collect()
        assert {r.arrival_seq: (r.status, r.checkin_order) for r in rows} == expected
        assert len(rows) == len(checkins)

        live = {r.arrival_seq: r.checkin_order for r in accept(*inputs, cfg).collect()}
        assert live == {s: order for s, (status, order) in expected.items() if status == "ACCEPT"}

        remembered = model.decide(checkins, daily, set(logged), cfg, set(seen))
        rows = decide(*inputs, cfg, seen=marked).collect()
        assert {r.arrival_seq: (r.status, r.checkin_order) for r in rows} == remembered


JAN, FEB = dt.date(2024, 1, 5), dt.date(2024, 2, 5)
FULL = [(1, dt.date(2024, 1, d)) for d in (1, 2)]


def statuses(spark, checkins, daily=(), logged=(), cfg=CONFIGS[0]):
    rows = decide(*frames(spark, checkins, daily, logged), cfg).collect()
    return {r.arrival_seq: r.status for r in rows}


def test_quota_reject_is_not_remembered(spark):
    copies = [Checkin("e", 1, JAN, 1), Checkin("e", 1, JAN, 2), Checkin("e", 1, FEB, 3), Checkin("e", 1, FEB, 4)]
    assert statuses(spark, copies, FULL) == {1: "LIMIT", 2: "LIMIT", 3: "ACCEPT", 4: "DUP_STATE"}


def test_ledger_duplicate_is_remembered(spark):
    copies = [Checkin("e", 1, JAN, 1), Checkin("e", 1, JAN, 2)]
    assert statuses(spark, copies, FULL, ["e"]) == {1: "DUP_LEDGER", 2: "DUP_STATE"}


def test_same_id_under_two_users(spark):
    copies = [Checkin("e", 1, JAN, 1), Checkin("e", 2, JAN, 2)]
    assert statuses(spark, copies) == {1: "ACCEPT", 2: "ACCEPT"}
    assert statuses(spark, copies, logged=["e"]) == {1: "DUP_LEDGER", 2: "DUP_LEDGER"}


def test_two_events_of_one_day(spark):
    events = [Checkin(f"e{k}", 1, JAN, k) for k in range(4)]
    assert set(statuses(spark, events).values()) == {"ACCEPT"}
    in_turn = statuses(spark, events, cfg=CONFIGS[1])
    assert in_turn == {0: "ACCEPT", 1: "ACCEPT", 2: "LIMIT", 3: "LIMIT"}


def test_an_event_over_the_quota_is_not_remembered_in_sequence(spark):
    """A full month leaves the event free for a copy in another month."""
    once = CONFIGS[1].with_(max_per_month=1)
    copies = [Checkin("x", 1, JAN, 1), Checkin("y", 1, JAN, 2), Checkin("y", 1, FEB, 3), Checkin("y", 1, FEB, 4)]
    assert statuses(spark, copies, cfg=once) == {1: "ACCEPT", 2: "LIMIT", 3: "ACCEPT", 4: "DUP_STATE"}
    # y's second copy fills February before z gets there, and z goes on to March.
    more = copies[:3] + [Checkin("z", 1, FEB, 5), Checkin("z", 1, dt.date(2024, 3, 5), 6)]
    assert statuses(spark, more, cfg=once) == {1: "ACCEPT", 2: "LIMIT", 3: "ACCEPT", 5: "LIMIT", 6: "ACCEPT"}


def test_quota_exactly_met(spark):
    assert statuses(spark, [Checkin("e", 1, JAN, 1)], FULL[:1]) == {1: "ACCEPT"}
    assert statuses(spark, [Checkin("e", 1, JAN, 1)], FULL) == {1: "LIMIT"}
