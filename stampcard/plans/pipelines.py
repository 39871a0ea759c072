"""The batch pipelines a user calls."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from stampcard.config import EngineConfig
from stampcard.functions.rules import to_processed, to_transactions
from stampcard.operators.decide import accept, decide


def award_points_live(
    checkins: DataFrame,
    daily_checkin: DataFrame,
    checkin_events: DataFrame,
    cfg: EngineConfig,
    processed_at: Column | None = None,
    cut: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Point transactions of the accepted check-ins; rejects are dropped."""
    accepted = accept(checkins, daily_checkin, checkin_events, cfg, cut)
    return to_transactions(accepted, cfg, processed_at)


def audit_checkins(
    checkins: DataFrame,
    daily_checkin: DataFrame,
    checkin_events: DataFrame,
    cfg: EngineConfig,
    seen: DataFrame | None = None,
    cut: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One processed row per check-in, rejects included. Keeps
    ``arrival_seq``, by which ``apply_ledger`` orders the rows."""
    return to_processed(decide(checkins, daily_checkin, checkin_events, cfg, seen, cut), cfg)
