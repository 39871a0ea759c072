"""The rules one event at a time, in plain Python, to check the set form."""

import datetime as dt
from dataclasses import dataclass

SCHEMA = (
    "event_id string, user_id bigint, checkin_date date, event_timestamp timestamp_ntz, "
    "year_month string, metadata struct<source:string,version:string,request_id:string,"
    "client_ip:string,user_agent:string>, arrival_seq bigint"
)


@dataclass(frozen=True)
class Checkin:
    event_id: str
    user_id: int
    date: dt.date
    seq: int

    def row(self):
        at = dt.datetime.combine(self.date, dt.time(10))
        return (self.event_id, self.user_id, self.date, at, f"{self.date:%Y-%m}", None, self.seq)


def month_of(date):
    return (date.year, date.month)


def points(order, ladder):
    return ladder[order - 1] if order <= len(ladder) else ladder[-1]


def decide(checkins, daily, logged, cfg, state=None):
    """{seq: (status, order)}; ``daily`` is (user, date) pairs, ``logged`` ids."""
    state = set() if state is None else state
    accepted = {}
    result = {}
    for c in sorted(checkins, key=lambda c: c.seq):
        key = (c.user_id, c.event_id)
        month = (c.user_id, month_of(c.date))
        count = sum(1 for u, d in daily if (u, month_of(d)) == month)
        if cfg.order_mode == "sequential":
            count += accepted.get(month, 0)
        if key in state:
            result[c.seq] = ("DUP_STATE", None)
        elif c.event_id in logged:
            state.add(key)
            result[c.seq] = ("DUP_LEDGER", None)
        elif count >= cfg.max_per_month:
            result[c.seq] = ("LIMIT", None)
        else:
            state.add(key)
            accepted[month] = accepted.get(month, 0) + 1
            result[c.seq] = ("ACCEPT", count + 1)
    return result


def apply(checkins, decisions, daily, logged, cfg):
    """Rows added to the tables: daily, log (event id -> processed), points."""
    taken = set(daily)
    log = {}
    added = {}
    rows = []
    for c in sorted(checkins, key=lambda c: c.seq):
        status, order = decisions[c.seq]
        done = False
        if status == "ACCEPT" and (c.user_id, c.date) not in taken:
            earned = points(order, cfg.points_ladder)
            taken.add((c.user_id, c.date))
            rows.append((c.user_id, c.date, earned, order))
            added[c.user_id] = added.get(c.user_id, 0) + earned
            done = True
        if c.event_id not in logged and c.event_id not in log:
            log[c.event_id] = (c.user_id, done, status)
    return rows, log, added
