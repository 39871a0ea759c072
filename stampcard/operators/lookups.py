"""Joins against the ledger tables, one per batch instead of one per event.

Skew. A user or an event id may own a third of all rows, so a lookup join must
not send all rows of a key to one task:

* ``salted_left_join`` spreads the rows of a key over several join keys and
  copies the looked-up side once per salt. It is used where that side is an
  aggregate. Joining straight onto an aggregate would reuse the aggregate's
  own partitioning, and adaptive execution splits a skewed partition only
  where both sides are shuffled for the join. The salt brings that about, so
  a hot key is first dealt out by salt and then split by size, as often as it
  takes; two salts are enough for that and copy little.
* Semi and anti joins read the ledger as it is, so both sides are shuffled
  for the join and adaptive execution can split the hot one.

No join carries a broadcast hint: Spark broadcasts a side only where its size
is known to lie below the configured threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stampcard.functions.rules import quota_month

SALT = "__salt"


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: list[str],
    salts: int = 2,
) -> DataFrame:
    """Left join where ``right`` has one row per ``on``. The result keeps the
    salt column.

    ``spread_by`` are left columns that differ between rows of one key.
    """
    spread = left.withColumn(SALT, F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = right.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*on, SALT], "left")


def matching(ledger: DataFrame, batch: DataFrame, key: str, batch_key: str | None = None) -> DataFrame:
    """Ledger rows whose ``key`` occurs in the batch.

    For a batch much smaller than the ledger: the batch's keys are broadcast
    where they are few, and then the ledger is only scanned; else its rows are
    shuffled once, and lookups after this see the matching ones only.
    """
    keys = batch.select(F.col(batch_key or key).alias(key)).distinct()
    return ledger.join(keys, key, "left_semi")


def monthly_counts(daily_checkin: DataFrame) -> DataFrame:
    """Check-ins per user and quota month."""
    return (
        daily_checkin.select("user_id", quota_month(F.col("checkin_date")).alias("quota_month"))
        .groupBy("user_id", "quota_month")
        .agg(F.count(F.lit(1)).alias("month_count"))
    )


def with_month_count(
    df: DataFrame, daily_checkin: DataFrame, spread_by: list[str], salts: int = 2
) -> DataFrame:
    """Add ``month_count``, the user's ledger rows in the row's quota month."""
    counted = salted_left_join(
        df,
        monthly_counts(daily_checkin),
        on=["user_id", "quota_month"],
        spread_by=spread_by,
        salts=salts,
    )
    return counted.drop(SALT).withColumn(
        "month_count", F.coalesce("month_count", F.lit(0).cast("bigint"))
    )


def mark_ledger_duplicates(
    df: DataFrame, checkin_events: DataFrame, spread_by: list[str], keep_salt: bool = False
) -> DataFrame:
    """Add ``in_ledger``: the event id was logged before, for any user and
    whatever its ``processed`` flag. Row count is kept.

    With ``keep_salt`` the salt stays, so that later grouping by event id and
    salt needs no shuffle of its own.
    """
    logged = checkin_events.select("event_id").distinct().withColumn("in_ledger", F.lit(True))
    marked = salted_left_join(df, logged, on=["event_id"], spread_by=spread_by)
    marked = marked.withColumn("in_ledger", F.coalesce("in_ledger", F.lit(False)))
    return marked if keep_salt else marked.drop(SALT)


def new_events(df: DataFrame, checkin_events: DataFrame) -> DataFrame:
    """Rows whose event id the ledger does not hold."""
    return df.join(checkin_events.select("event_id"), "event_id", "left_anti")


def logged_events(df: DataFrame, checkin_events: DataFrame) -> DataFrame:
    """Rows whose event id the ledger already holds."""
    return df.join(checkin_events.select("event_id"), "event_id", "left_semi")


def unknown_users(df: DataFrame, users: DataFrame) -> DataFrame:
    """Rows of users that have no row in ``users``."""
    return df.join(users.select(F.col("id").alias("user_id")), "user_id", "left_anti")
