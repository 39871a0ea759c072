"""The reward rules as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stampcard.config import EngineConfig

# Texts written to results and to the points history.
DUPLICATE_MESSAGE = "Duplicate event"
LIMIT_MESSAGE = "Maximum {max} check-ins per month reached"
HISTORY_DESCRIPTION = "Daily check-in #%d (event-driven)"
HISTORY_TYPE = "CHECKIN"
TRANSACTION_ID_FORMAT = "%d_%s_%d_%d"

# Outcome of one event.
ACCEPT = "ACCEPT"
DUP_STATE = "DUP_STATE"
DUP_LEDGER = "DUP_LEDGER"
LIMIT = "LIMIT"


def quota_month(date: Column) -> Column:
    """First day of the month whose quota a check-in uses."""
    return F.trunc(date, "month").cast("date")


def with_quota_month(df: DataFrame) -> DataFrame:
    """Add ``quota_month``. It follows ``checkin_date``; the ``year_month``
    text of the record is passed through and may disagree."""
    return df.withColumn("quota_month", quota_month(F.col("checkin_date")))


def points_for_order(order: Column, ladder: Sequence[int]) -> Column:
    """Points of the n-th check-in; past the last step the last step counts."""
    steps = F.array(*[F.lit(int(points)) for points in ladder])
    return F.element_at(steps, F.least(order, F.lit(len(ladder))).cast("int"))


def epoch_millis(time: Column) -> Column:
    """Milliseconds since 1970 of a zone-less time, in the session's zone,
    which ``tune`` sets to UTC."""
    return F.unix_millis(time.cast("timestamp"))


def transaction_id(mode: str, processed_at: Column) -> Column:
    """Id of a transaction row with user, month text, order and event columns.

    ``reference`` ends in the clock, so a replay gets another id, and two
    events of one batch with the same order get the same id. ``deterministic``
    ends in the event id instead and has neither problem.
    """
    if mode == "reference":
        return F.format_string(
            TRANSACTION_ID_FORMAT,
            F.col("user_id"),
            F.col("year_month"),
            F.col("checkin_order"),
            epoch_millis(processed_at),
        )
    return F.format_string(
        "%d_%s_%d_%s",
        F.col("user_id"),
        F.col("year_month"),
        F.col("checkin_order"),
        F.col("event_id"),
    )


def to_transactions(
    accepted: DataFrame,
    cfg: EngineConfig,
    processed_at: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Point transactions of accepted check-ins that carry their order, with
    the columns named in ``keep`` behind."""
    clock = F.localtimestamp() if processed_at is None else processed_at
    return accepted.select(
        transaction_id(cfg.id_mode, clock).alias("transaction_id"),
        "event_id",
        "user_id",
        "checkin_date",
        "year_month",
        points_for_order(F.col("checkin_order"), cfg.points_ladder).alias("points_earned"),
        F.col("checkin_order").cast("int").alias("checkin_order"),
        "event_timestamp",
        clock.alias("processed_at"),
        "metadata",
        *keep,
    )


def to_processed(decided: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One result row per decided check-in; rejects carry 0 points, order 0."""
    accepted = F.col("status") == ACCEPT
    duplicate = F.col("status").isin(DUP_STATE, DUP_LEDGER)
    limit_text = LIMIT_MESSAGE.format(max=cfg.max_per_month)
    return decided.select(
        "event_id",
        "user_id",
        "checkin_date",
        "event_timestamp",
        "year_month",
        F.when(accepted, points_for_order(F.col("checkin_order"), cfg.points_ladder))
        .otherwise(F.lit(0))
        .alias("points_earned"),
        F.when(accepted, F.col("checkin_order").cast("int"))
        .otherwise(F.lit(0))
        .alias("checkin_order"),
        duplicate.alias("duplicate"),
        F.when(duplicate, F.lit(DUPLICATE_MESSAGE))
        .when(~accepted, F.lit(limit_text))
        .alias("error_message"),
        "arrival_seq",
    )


def history_description(order: Column) -> Column:
    return F.format_string(HISTORY_DESCRIPTION, order)
