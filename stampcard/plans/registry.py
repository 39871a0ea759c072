"""Named queries: each runs one operator or pipeline over the whole tables.

Dates, times and nested fields are given out as text and plain columns, so
that results of two engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stampcard.config import EngineConfig
from stampcard.functions.rules import points_for_order, transaction_id, with_quota_month
from stampcard.operators import decide as D
from stampcard.operators import dedup, ledger, lookups
from stampcard.plans import workload as W
from stampcard.plans.pipelines import audit_checkins, award_points_live
from stampcard.session import scratch_path, tune
from stampcard.sources import wire
from stampcard.streaming import bounded

CFG = EngineConfig()
SEQUENTIAL = CFG.with_(order_mode="sequential")
STABLE_IDS = CFG.with_(id_mode="deterministic")
MANY_MONTHS = EngineConfig(points_ladder=(1, 2), max_per_month=2, order_mode="sequential")


def flat(df: DataFrame) -> DataFrame:
    """Dates and times as text, struct fields as columns of their own."""
    columns = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "date":
            columns.append(F.date_format(field.name, "yyyy-MM-dd").alias(field.name))
        elif kind == "timestamp_ntz":
            columns.append(
                F.date_format(field.name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
            )
        elif kind == "struct":
            columns += [
                F.col(f"{field.name}.{inner}").alias(f"{field.name}_{inner}")
                for inner in field.dataType.fieldNames()
            ]
        else:
            columns.append(F.col(field.name))
    return df.select(*columns)


class Inputs:
    """The derived tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = tune(spark)
        self.sf_dir = sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return W.events(self.spark, self.sf_dir)

    @cached_property
    def checkins(self) -> DataFrame:
        return W.checkins_of(self.events)

    @cached_property
    def daily(self) -> DataFrame:
        return W.daily_checkin_of(self.events, CFG)

    @cached_property
    def logged(self) -> DataFrame:
        return W.checkin_events_of(self.events)

    @cached_property
    def users(self) -> DataFrame:
        return W.users(self.spark, self.sf_dir)

    def audited(self, cfg: EngineConfig = SEQUENTIAL) -> DataFrame:
        cut = self.written if cfg.order_mode == "sequential" else None
        return audit_checkins(self.checkins, self.daily, self.logged, cfg, cut=cut)

    def decided(self, cfg: EngineConfig = CFG) -> DataFrame:
        return D.decide(self.checkins, self.daily, self.logged, cfg)

    def transactions(self, cfg: EngineConfig = CFG) -> DataFrame:
        return award_points_live(self.checkins, self.daily, self.logged, cfg, W.now(), self.written)

    def changes(self) -> ledger.LedgerChanges:
        # Audited rows feed several tables, so their plan is cut here.
        rows = self.written(self.audited())
        return ledger.apply_ledger(
            rows, self.users, self.daily, self.logged, W.now(), on_missing="quarantine", cut=self.written
        )

    def written(self, df: DataFrame) -> DataFrame:
        """Cut the plan: write to the shared folder and read back."""
        path = scratch_path(self.spark, "cut")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def decode_checkins(i: Inputs) -> DataFrame:
    rows = i.checkins.select(W.checkin_json().alias("value"), "arrival_seq")
    return wire.decode_checkins(rows)


def decode_quarantine(i: Inputs) -> DataFrame:
    records = W.damaged_records_of(i.events)
    decoded = wire.decode_checkins(records, on_error="quarantine")
    usable = F.col("reason").isNull()
    return decoded.select(
        "arrival_seq",
        F.coalesce("reason", F.lit("OK")).alias("outcome"),
        F.when(usable, F.col("event_id")).alias("event_id"),
        F.when(usable, F.col("user_id")).alias("user_id"),
    )


def quota_month(i: Inputs) -> DataFrame:
    return with_quota_month(i.checkins).select(
        "arrival_seq",
        F.year("quota_month").alias("year"),
        F.month("quota_month").alias("month"),
        "year_month",
    )


def points_ladder(i: Inputs) -> DataFrame:
    """Points of each day of month taken as an order, so 1 to 31."""
    order = F.dayofmonth("checkin_date")
    return i.checkins.select(
        "arrival_seq",
        order.alias("checkin_order"),
        points_for_order(order, CFG.points_ladder).alias("points_earned"),
    )


def transaction_ids(i: Inputs) -> DataFrame:
    accepted = D.accept(i.checkins, i.daily, i.logged, CFG)
    modes = ("reference", "deterministic")
    ids = [F.struct(F.lit(m).alias("id_mode"), transaction_id(m, W.now()).alias("transaction_id")) for m in modes]
    return accepted.select("event_id", "user_id", F.explode(F.array(*ids)).alias("id")).select(
        "event_id", "user_id", "id.*"
    )


def checkin_order(cfg: EngineConfig) -> Callable[[Inputs], DataFrame]:
    def run(i: Inputs) -> DataFrame:
        return D.accept(i.checkins, i.daily, i.logged, cfg).select(
            "event_id", "user_id", "checkin_date", "checkin_order", "arrival_seq"
        )

    return run


def many_month_sequential(i: Inputs) -> DataFrame:
    checkins = W.order_checkins(i.spark, i.sf_dir)
    daily = i.spark.createDataFrame([], "user_id bigint, checkin_date date")
    logged = i.spark.createDataFrame([], "event_id string")
    return audit_checkins(checkins, daily, logged, MANY_MONTHS, cut=i.written)


def monthly_quota(i: Inputs) -> DataFrame:
    rows = with_quota_month(i.checkins)
    counted = lookups.with_month_count(rows, i.daily, ["arrival_seq"], CFG.count_salts)
    return counted.select(
        "arrival_seq",
        "user_id",
        "month_count",
        (F.col("month_count") >= CFG.max_per_month).alias("over_quota"),
    )


def monthly_counts(i: Inputs) -> DataFrame:
    """Of all check-in days, whether or not a quota would let them pass."""
    return lookups.monthly_counts(W.checkin_days_of(i.checkins)).select(
        "user_id",
        F.year("quota_month").alias("year"),
        F.month("quota_month").alias("month"),
        "month_count",
    )


def ledger_duplicates(i: Inputs) -> DataFrame:
    return lookups.mark_ledger_duplicates(
        i.checkins.select("arrival_seq", "event_id", "user_id"), i.logged, ["arrival_seq"]
    )


def new_events_anti_join(i: Inputs) -> DataFrame:
    return lookups.new_events(i.checkins, i.logged).drop("metadata")


def dedup_first_arrival(i: Inputs) -> DataFrame:
    return dedup.dedup_first_arrival(i.checkins)


def decision_status(i: Inputs) -> DataFrame:
    return i.decided().select("arrival_seq", "event_id", "user_id", "status", "checkin_order")


def insert_ignore_events(i: Inputs) -> DataFrame:
    rows = dedup.insert_ignore(i.checkins, i.logged, "event_id")
    return rows.select("event_id", "user_id", "checkin_date", "arrival_seq")


def same_day_guard(i: Inputs) -> DataFrame:
    rows = i.written(i.audited(CFG))
    return ledger.same_day_guard(rows, i.daily).select(
        "event_id", "user_id", "checkin_date", "arrival_seq", "same_day"
    )


def unknown_users(i: Inputs) -> DataFrame:
    rows = lookups.unknown_users(i.checkins, W.users_in_credit(i.spark, i.sf_dir))
    return rows.select("event_id", "user_id", "arrival_seq")


def sink_routing(i: Inputs) -> DataFrame:
    return ledger.sink_routing(i.audited(CFG)).select(
        "arrival_seq", "event_id", "user_id", "duplicate", "error_message", "route"
    )


def user_balances(i: Inputs) -> DataFrame:
    return ledger.user_balances(i.users, i.changes().user_points, W.now())


def dedup_stream_available_now(i: Inputs) -> DataFrame:
    return bounded.dedup_stream(i.spark, i.sf_dir, CFG)


def live_stream_available_now(i: Inputs) -> DataFrame:
    return bounded.live_stream(i.spark, i.sf_dir, STABLE_IDS)


def ledger_stream_available_now(i: Inputs) -> DataFrame:
    return bounded.ledger_stream(i.spark, i.sf_dir, SEQUENTIAL)


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "award_points_live": lambda i: i.transactions(),
    "award_points_sequential": lambda i: i.transactions(SEQUENTIAL),
    "audit_checkins": lambda i: i.audited(CFG),
    "audit_checkins_sequential": lambda i: i.audited(),
    "decode_checkins": decode_checkins,
    "decode_quarantine": decode_quarantine,
    "quota_month": quota_month,
    "points_ladder": points_ladder,
    "transaction_ids": transaction_ids,
    "checkin_order_snapshot": checkin_order(CFG),
    "checkin_order_sequential": checkin_order(SEQUENTIAL),
    "many_month_sequential": many_month_sequential,
    "monthly_quota": monthly_quota,
    "monthly_counts": monthly_counts,
    "ledger_duplicates": ledger_duplicates,
    "new_events_anti_join": new_events_anti_join,
    "dedup_first_arrival": dedup_first_arrival,
    "decision_status": decision_status,
    "decision_metrics": lambda i: D.decision_metrics(i.decided()),
    "insert_ignore_events": insert_ignore_events,
    "same_day_guard": same_day_guard,
    "unknown_users": unknown_users,
    "sink_routing": sink_routing,
    "ledger_daily_rows": lambda i: i.changes().daily_checkin,
    "points_history_rows": lambda i: i.changes().user_points_history,
    "ledger_event_log": lambda i: i.changes().checkin_events,
    "user_balances": user_balances,
    "encode_transactions": lambda i: wire.encode_transactions(i.transactions()),
    "kafka_records": lambda i: wire.kafka_records(i.transactions()),
    "dedup_stream_available_now": dedup_stream_available_now,
    "live_stream_available_now": live_stream_available_now,
    "ledger_stream_available_now": ledger_stream_available_now,
}


def runner(query: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: flat(query(Inputs(spark, sf_dir)))
