"""Applying processed check-ins to the four ledger tables.

The rows are taken in arrival order, as if applied one by one:

* duplicates and errors are only logged;
* a (user, date) that has a check-in already, in the ledger or earlier in the
  batch, is only logged, unprocessed, with its points and without an error;
* any other row adds its points to the user, and adds one daily row, one
  history row and a processed log row;
* a log row never replaces one with the same event id.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stampcard.functions.rules import HISTORY_TYPE, history_description
from stampcard.operators.dedup import first_of_day, insert_ignore
from stampcard.operators.lookups import unknown_users

DAY_KEY = ["user_id", "checkin_date"]
ROW_KEY = ["event_id", "user_id", "arrival_seq"]


class UnknownUserError(RuntimeError):
    """A check-in to apply belongs to a user without a row in ``users``."""


@dataclass(frozen=True)
class LedgerChanges:
    """Rows to add to each table, and points to add per user."""

    daily_checkin: DataFrame
    user_points_history: DataFrame
    checkin_events: DataFrame
    user_points: DataFrame
    unknown_user_rows: DataFrame


def to_apply(processed: DataFrame) -> DataFrame:
    """Rows that are neither duplicates nor errors."""
    return processed.filter(~F.col("duplicate") & F.col("error_message").isNull())


def log_only(processed: DataFrame) -> DataFrame:
    """Duplicates and errors."""
    return processed.filter(F.col("duplicate") | F.col("error_message").isNotNull())


def sink_routing(processed: DataFrame) -> DataFrame:
    """Add ``route``: ``LOG_ONLY`` or ``APPLY``."""
    logged = F.col("duplicate") | F.col("error_message").isNotNull()
    return processed.withColumn("route", F.when(logged, "LOG_ONLY").otherwise("APPLY"))


def day_winners(processed: DataFrame, daily_checkin: DataFrame) -> DataFrame:
    """Rows that pass the same-day guard: first of their day, day still free."""
    return first_of_day(to_apply(processed)).join(
        daily_checkin.select(*DAY_KEY), DAY_KEY, "left_anti"
    )


def same_day_guard(processed: DataFrame, daily_checkin: DataFrame) -> DataFrame:
    """Rows to apply with ``same_day``: true where the guard stops the row."""
    rows = to_apply(processed)
    winners = day_winners(processed, daily_checkin).select(*ROW_KEY)
    marked = rows.join(winners.withColumn("__wins", F.lit(True)), ROW_KEY, "left")
    return marked.withColumn("same_day", F.col("__wins").isNull()).drop("__wins")


def user_point_deltas(applied: DataFrame) -> DataFrame:
    """Points to add per user."""
    return applied.groupBy("user_id").agg(F.sum("points_earned").alias("points_added"))


def user_balances(users: DataFrame, deltas: DataFrame, now: Column) -> DataFrame:
    """``users`` after adding the deltas; untouched users keep their row."""
    added = deltas.withColumnRenamed("user_id", "id")
    return users.join(added, "id", "left").select(
        "id",
        (F.col("total_points") + F.coalesce("points_added", F.lit(0))).alias("total_points"),
        F.when(F.col("points_added").isNotNull(), now)
        .otherwise(F.col("updated_at"))
        .alias("updated_at"),
    )


def daily_rows(applied: DataFrame, now: Column) -> DataFrame:
    return applied.select(*DAY_KEY, "points_earned", "checkin_order", now.alias("created_at"))


def history_rows(applied: DataFrame, now: Column) -> DataFrame:
    return applied.select(
        "user_id",
        F.col("points_earned").alias("points"),
        F.lit(HISTORY_TYPE).alias("transaction_type"),
        history_description(F.col("checkin_order")).alias("description"),
        now.alias("created_at"),
    )


def event_log_rows(
    processed: DataFrame, applied: DataFrame, checkin_events: DataFrame, now: Column
) -> DataFrame:
    """Log rows to append to ``checkin_events``."""
    logged = insert_ignore(processed, checkin_events, "event_id")
    done = applied.select(*ROW_KEY).withColumn("processed", F.lit(True))
    return logged.join(done, ROW_KEY, "left").select(
        "event_id",
        "user_id",
        "checkin_date",
        "event_timestamp",
        "year_month",
        "points_earned",
        F.coalesce("processed", F.lit(False)).alias("processed"),
        F.when(F.col("processed"), now).alias("processed_at"),
        "error_message",
        now.alias("created_at"),
        now.alias("updated_at"),
    )


def apply_ledger(
    processed: DataFrame,
    users: DataFrame,
    daily_checkin: DataFrame,
    checkin_events: DataFrame,
    now: Column,
    on_missing: str = "fail",
    cut: Callable[[DataFrame], DataFrame] | None = None,
) -> LedgerChanges:
    """Changes that ``processed`` makes to the ledger.

    ``on_missing="fail"`` raises before anything is written if a row to apply
    belongs to an unknown user. ``"quarantine"`` takes those rows out whole:
    they are neither applied nor logged.

    Several tables are derived from ``processed`` and from the rows to apply.
    Pass a ``processed`` that was written to a table where its plan is
    expensive, and ``cut``, a function that writes a frame to a table and
    returns it as written, where more than one of the tables is used.
    """
    if on_missing not in ("fail", "quarantine"):
        raise ValueError(f"unknown on_missing: {on_missing!r}")
    winners = day_winners(processed, daily_checkin)
    if cut is not None:
        winners = cut(winners)
    strangers = unknown_users(winners, users)
    if on_missing == "fail":
        first = strangers.select("user_id").head()
        if first is not None:
            raise UnknownUserError(f"user not found: {first.user_id}")
        applied = winners
        rejected = strangers
    else:
        # Every eligible copy of a stranger's free day would fail, so all of
        # them leave, not only the day's first.
        days = strangers.select(*DAY_KEY)
        rejected = to_apply(processed).join(days, DAY_KEY, "left_semi")
        applied = winners.join(days, DAY_KEY, "left_anti")
        processed = processed.join(rejected.select(*ROW_KEY), ROW_KEY, "left_anti")
    return LedgerChanges(
        daily_checkin=daily_rows(applied, now),
        user_points_history=history_rows(applied, now),
        checkin_events=event_log_rows(processed, applied, checkin_events, now),
        user_points=user_point_deltas(applied),
        unknown_user_rows=rejected,
    )
