"""The decision rule.

Per user and in arrival order, against a ledger that stands still for the
batch, an event is

* ``DUP_STATE`` if the user's event id was marked before,
* else ``DUP_LEDGER`` if the ledger holds the event id; it is marked,
* else ``LIMIT`` if the user's month is full; it is *not* marked,
* else ``ACCEPT``; it is marked.

In snapshot mode a month is full or not for the whole batch, so whether a copy
marks depends only on its event id, user and quota month, and a copy is
``DUP_STATE`` exactly if it arrived after the earliest marking copy. ``accept``
needs only that earliest copy and takes it in one pass over the full records.
``decide`` keeps every row: it works out one narrow row per (user, event id,
month), the verdict, and joins it back to the records.

In sequential mode accepted events fill the month for later ones, and a copy
that a full month rejects leaves the event free for a copy in another month.
``settle`` finds the outcome of that on the verdicts, see there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stampcard.config import EngineConfig
from stampcard.functions.rules import ACCEPT, DUP_LEDGER, DUP_STATE, LIMIT, with_quota_month
from stampcard.operators.dedup import first_per_key
from stampcard.operators.lookups import (
    SALT,
    mark_ledger_duplicates,
    new_events,
    with_month_count,
)
from stampcard.session import scratch_path

#: Writes a frame to a table and returns it as written.
Cut = Callable[[DataFrame], DataFrame]

EVENT_KEY = ["user_id", "event_id"]
COPY_KEY = ["user_id", "event_id", "quota_month"]


def _has_quota(cfg: EngineConfig) -> Column:
    return F.col("month_count") < F.lit(cfg.max_per_month)


def verdicts(
    checkins: DataFrame,
    daily_checkin: DataFrame,
    checkin_events: DataFrame,
    cfg: EngineConfig,
    seen: DataFrame | None = None,
) -> DataFrame:
    """One row per user, event id and quota month with ``first_arrival``,
    ``month_count``, ``in_ledger``, ``in_state`` and ``first_mark``, the
    earliest marking arrival of the (user, event id).

    ``seen`` holds the (user, event id) pairs still remembered from earlier
    batches, each once.

    The ledger join deals rows out by event id and a salt that follows from
    the user. Folding the copies and looking for the first mark group by both
    as well, so they run where the join left the rows.
    """
    rows = with_quota_month(checkins.select(*EVENT_KEY, "checkin_date", "arrival_seq"))
    counted = with_month_count(
        rows.select(*COPY_KEY, "arrival_seq"), daily_checkin, ["arrival_seq"], cfg.count_salts
    )
    marked = mark_ledger_duplicates(counted, checkin_events, ["user_id"], keep_salt=True)
    folded = marked.groupBy(*COPY_KEY, SALT, "month_count", "in_ledger").agg(
        F.min("arrival_seq").alias("first_arrival")
    )
    marks = F.col("in_ledger") | _has_quota(cfg)
    copies = Window.partitionBy(*EVENT_KEY, SALT)
    ruled = folded.withColumn(
        "first_mark", F.min(F.when(marks, F.col("first_arrival"))).over(copies)
    ).drop(SALT)
    if seen is None:
        return ruled.withColumn("in_state", F.lit(False))
    known = seen.select(*EVENT_KEY).withColumn("in_state", F.lit(True))
    return ruled.join(known, EVENT_KEY, "left").withColumn(
        "in_state", F.coalesce("in_state", F.lit(False))
    )


def settle(ruled: DataFrame, cfg: EngineConfig, cut: Cut) -> DataFrame:
    """Verdicts of sequential mode: ``first_mark`` becomes the arrival of the
    copy that is accepted, null if none is, and ``checkin_order`` its order.

    Every event proposes its earliest copy to that copy's month. A month keeps
    the first proposals by arrival that it has room for; a month that is full
    stays full, and takes nothing that arrives after the last one it keeps. Such
    copies are out, proposed or not, and their events propose the next copy in
    another month. When no month's last one changes any more, what the months
    keep is what a fold over the events in order would accept: an event's copy
    is turned down exactly if the month was filled by accepted copies that
    arrived before it.

    A round writes one row per full month. The first one that finds some also
    writes the copies still open; as those that are out stay out, the later rounds
    read these only. Ranks are limited to the quota before and after the shuffle.
    """
    free = ~F.col("in_state") & ~F.col("in_ledger") & _has_quota(cfg)
    rows = ruled.filter(free).select(*COPY_KEY, "month_count", "first_arrival")
    month_key = ["user_id", "quota_month"]
    month = Window.partitionBy(*month_key).orderBy("first_arrival")
    room = F.lit(cfg.max_per_month) - F.col("month_count")

    def still_open(rows: DataFrame, full: DataFrame) -> DataFrame:
        open_ = rows.join(full, month_key, "left").filter(
            F.col("__last").isNull() | (F.col("first_arrival") <= F.col("__last"))
        )
        return open_.drop("__last")

    def proposals(full: DataFrame | None) -> DataFrame:
        open_ = rows if full is None else still_open(rows, full)
        return first_per_key(open_, EVENT_KEY, "first_arrival")

    full, before = None, None
    while True:
        kept = (
            proposals(full)
            .withColumn("__rank", F.row_number().over(month))
            .filter(F.col("__rank") <= F.lit(cfg.max_per_month))
            .filter(F.col("__rank") <= room)
        )
        ends = kept.groupBy(*month_key).agg(
            F.max("first_arrival").alias("__last"), F.max(F.col("__rank") - room).alias("__left")
        )
        full = cut(ends.filter("__left = 0").select(*month_key, "__last"))
        now = full.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*month_key, "__last"))).head()
        if now[0] == 0 or now == before:
            break
        if before is None:
            rows = cut(still_open(rows, full))
        before = now
    # What is still proposed is kept, so a month has no more rows than its quota.
    accepted = proposals(full).select(
        *EVENT_KEY,
        F.col("first_arrival").alias("__accepted"),
        (F.col("month_count") + F.row_number().over(month)).cast("int").alias("checkin_order"),
    )
    joined = ruled.join(accepted, EVENT_KEY, "left")
    first_mark = F.when(F.col("in_ledger"), F.col("first_mark")).otherwise(F.col("__accepted"))
    return joined.withColumn("first_mark", first_mark).drop("__accepted")


def with_orders(ruled: DataFrame, cfg: EngineConfig, cut: Cut) -> DataFrame:
    """Verdicts with ``checkin_order``, the order of the copy that arrived at
    ``first_mark`` if that is accepted.

    ``snapshot``: ledger count + 1. Events of one batch do not count for each
    other, so orders can repeat and the quota can be exceeded.
    ``sequential``: see ``settle``.
    """
    if cfg.order_mode == "sequential":
        return settle(cut(ruled), cfg, cut)
    return ruled.withColumn("checkin_order", (F.col("month_count") + 1).cast("int"))


def _scratch(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "decide")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def accept(
    checkins: DataFrame,
    daily_checkin: DataFrame,
    checkin_events: DataFrame,
    cfg: EngineConfig,
    cut: Cut | None = None,
) -> DataFrame:
    """Accepted check-ins only, with ``checkin_order``; rejects are dropped.

    The short form of the rule in snapshot mode: the first copy whose month has
    room and whose event id the ledger does not hold. The ledger join leaves the
    rows dealt out by event id, which serves the search for the first copy too:
    full records are shuffled once, or twice where the month counts are large.
    In sequential mode the narrow verdicts are settled first, and the accepted
    arrivals joined to the records.
    """
    if cfg.order_mode == "sequential":
        cut = cut or _scratch
        ruled = with_orders(verdicts(checkins, daily_checkin, checkin_events, cfg), cfg, cut)
        chosen = ruled.filter(
            ~F.col("in_ledger") & (F.col("first_arrival") == F.col("first_mark"))
        ).select(*EVENT_KEY, F.col("first_mark").alias("arrival_seq"), "month_count", "checkin_order")
        return with_quota_month(checkins).join(cut(chosen), [*EVENT_KEY, "arrival_seq"])
    counted = with_month_count(
        with_quota_month(checkins), daily_checkin, ["arrival_seq"], cfg.count_salts
    )
    fresh = new_events(counted.filter(_has_quota(cfg)), checkin_events)
    first = first_per_key(fresh, EVENT_KEY)
    return first.withColumn("checkin_order", (F.col("month_count") + 1).cast("int"))


def decide(
    checkins: DataFrame,
    daily_checkin: DataFrame,
    checkin_events: DataFrame,
    cfg: EngineConfig,
    seen: DataFrame | None = None,
    cut: Cut | None = None,
) -> DataFrame:
    """Every check-in with its ``status`` and, where accepted, its order.

    ``cut`` is a function that writes a frame to a table and returns it as
    written. Sequential mode needs one and takes a scratch table by default;
    its verdicts are cut before they are joined to the records, so that both
    sides of that join are scans and a hot key can be split.
    """
    ruled = verdicts(checkins, daily_checkin, checkin_events, cfg, seen)
    if cfg.order_mode == "sequential":
        cut = cut or _scratch
        return apply_verdicts(checkins, cut(with_orders(ruled, cfg, cut)))
    return apply_verdicts(checkins, with_orders(ruled if cut is None else cut(ruled), cfg, cut))


def apply_verdicts(checkins: DataFrame, ruled: DataFrame) -> DataFrame:
    """Statuses and orders of check-ins, from their verdicts with orders."""
    after_mark = F.col("arrival_seq") > F.col("first_mark")
    at_mark = F.col("arrival_seq") == F.col("first_mark")
    status = (
        F.when(F.col("in_state") | F.coalesce(after_mark, F.lit(False)), DUP_STATE)
        .when(F.col("in_ledger"), DUP_LEDGER)
        .when(F.coalesce(at_mark, F.lit(False)), ACCEPT)
        .otherwise(LIMIT)
    )
    joined = with_quota_month(checkins).join(ruled, COPY_KEY, "left").withColumn("status", status)
    return joined.withColumn(
        "checkin_order", F.when(F.col("status") == ACCEPT, F.col("checkin_order"))
    ).drop("first_arrival", "first_mark", "in_state", "in_ledger")


def decision_metrics(decided: DataFrame) -> DataFrame:
    """Number of check-ins per outcome."""
    return decided.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
