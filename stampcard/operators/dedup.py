"""Deduplication in set form.

The first row of a key is an aggregate, so each map task sends at most one row
per key: a key that holds a third of all rows arrives as one row per map task.
A window with ``row_number() = 1`` is limited before the shuffle only where
Spark plans that shuffle from the start. It loses the limit where the rows lie
right already and adaptive execution, having split a skewed join below, adds
the shuffle later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegerType, LongType, TimestampNTZType

#: Types of a fixed width, which a hash aggregate can keep.
PLAIN = (BooleanType, DateType, IntegerType, LongType, TimestampNTZType)


def first_per_key(df: DataFrame, keys: list[str], order_by: str = "arrival_seq") -> DataFrame:
    """The row of each key that arrived first.

    Where all other columns are numbers, dates or times, each is taken by itself,
    from the same row: such sums are kept in a hash table, a struct needs two sorts.
    """
    rest = [name for name in df.columns if name not in keys]
    if all(isinstance(df.schema[name].dataType, PLAIN) for name in rest):
        firsts = [F.min_by(name, order_by).alias(name) for name in rest]
        return df.groupBy(*keys).agg(*firsts).select(*keys, *rest)
    first = F.min_by(F.struct(*rest), order_by)
    return df.groupBy(*keys).agg(first.alias("__first")).select(*keys, "__first.*")


def dedup_first_arrival(df: DataFrame) -> DataFrame:
    """First arrival of each (user, event id).

    The same event id under another user is another key. Not
    ``dropDuplicates``, which may keep any of the copies.
    """
    return first_per_key(df, ["user_id", "event_id"])


def first_of_day(df: DataFrame) -> DataFrame:
    """First row of each user and check-in date."""
    return first_per_key(df, ["user_id", "checkin_date"])


def insert_ignore(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` to append: the first per key, unless the key exists.

    Existing rows are never changed. ``new`` carries ``arrival_seq``.
    """
    return first_per_key(new, [key]).join(existing.select(key), key, "left_anti")
