"""The ledger in a database, over JDBC.

No statement reads or writes more than a batch can touch. The batch's keys are
written to two small tables, and the ledger's rows are found by joins with them
inside the database, which are read in parts by a hash of the key. Changes are
staged, then applied in one transaction that begins by entering the batch's name
in a table where it can stand once. So a batch is applied once or not at all: a
repeat finds its name and changes nothing, and of two attempts at the same time
one fails. Keys and changes carry a fresh token for each attempt, and no attempt
removes another's rows before the batch is applied.

Besides the four ledger tables the database needs those of ``DATABASE_DDL``.
The statements are written for MySQL.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stampcard.config import EngineConfig
from stampcard.functions.rules import HISTORY_TYPE, history_description
from stampcard.operators.ledger import LedgerChanges
from stampcard.schemas import ledger_columns
from stampcard.sources.tables import DateRange

#: Tables the jobs keep in the database beside the ledger's own. ``batch`` and
#: ``attempt`` come first in the keys of the staging tables.
DATABASE_DDL = {
    "applied_batches": "batch VARCHAR(100) PRIMARY KEY, applied_at TIMESTAMP",
    "lookup_users": "batch VARCHAR(100), attempt CHAR(32), user_id BIGINT, part INT",
    "lookup_events": "batch VARCHAR(100), attempt CHAR(32), event_id VARCHAR(255), part INT",
    "staged_daily_checkin": "batch VARCHAR(100), attempt CHAR(32), user_id BIGINT, checkin_date DATE, "
    "points_earned INT, checkin_order INT, created_at TIMESTAMP, transaction_type VARCHAR(20), description VARCHAR(255)",
    "staged_checkin_events": "batch VARCHAR(100), attempt CHAR(32), event_id VARCHAR(255), user_id BIGINT, "
    "checkin_date DATE, event_timestamp TIMESTAMP(6), `year_month` VARCHAR(7), points_earned INT, processed BOOLEAN, "
    "processed_at TIMESTAMP(6), error_message VARCHAR(255), created_at TIMESTAMP(6), updated_at TIMESTAMP(6)",
}
BATCH_NAME = re.compile(r"[A-Za-z0-9_.-]+")


class LedgerConflict(RuntimeError):
    """A check inside a transaction did not hold; nothing was changed."""


@dataclass(frozen=True)
class Statement:
    """SQL with ``?`` for its values. With ``expect`` it is a query whose one
    number must be that, or the transaction ends."""

    sql: str
    values: tuple[Any, ...] = ()
    expect: int | None = None


class Database(Protocol):
    """What the ledger needs of a database."""

    def transaction(self, statements: Sequence[Statement]) -> None:
        """Run all statements, or leave everything as it was."""

    def number(self, query: str, values: tuple[Any, ...]) -> int:
        """The one number a query gives."""

    def append(self, table: str, rows: DataFrame) -> None: ...

    def read(self, query: str, parts: int) -> DataFrame:
        """Rows of a query with a column ``part`` from 0, read part by part."""


def jdbc_options(cfg: EngineConfig) -> dict[str, str]:
    """``fetchsize`` and ``useCursorFetch`` keep the MySQL driver from holding
    a whole result in one executor's memory."""
    return {
        "fetchsize": "10000",
        "useCursorFetch": "true",
        "url": cfg.jdbc_url,
        "user": cfg.jdbc_username,
        "password": cfg.jdbc_password,
    }


def read_options(cfg: EngineConfig, query: str, parts: int) -> dict[str, str]:
    """Read a query's result by ``parts`` tasks."""
    return {
        **jdbc_options(cfg),
        "dbtable": f"({query}) batch_rows",
        "partitionColumn": "part",
        "lowerBound": "0",
        "upperBound": str(parts),
        "numPartitions": str(parts),
    }


@dataclass(frozen=True)
class JdbcDatabase:
    """Statements go over a connection of the driver's, rows over Spark's JDBC
    reader and writer. ``connect`` gives a new ``java.sql.Connection``."""

    spark: SparkSession
    cfg: EngineConfig
    connect: Callable[[], Any] | None = None

    def _connection(self) -> Any:
        if self.connect is not None:
            return self.connect()
        drivers = self.spark.sparkContext._jvm.java.sql.DriverManager
        return drivers.getConnection(self.cfg.jdbc_url, self.cfg.jdbc_username, self.cfg.jdbc_password)

    @staticmethod
    def _run(connection: Any, statement: Statement, query: bool) -> int:
        prepared = connection.prepareStatement(statement.sql)
        try:
            for place, value in enumerate(statement.values, 1):
                prepared.setObject(place, value)
            if not query:
                return prepared.executeUpdate()
            rows = prepared.executeQuery()
            rows.next()
            return rows.getLong(1)
        finally:
            prepared.close()

    def transaction(self, statements: Sequence[Statement]) -> None:
        connection = self._connection()
        try:
            connection.setAutoCommit(False)
            try:
                for statement in statements:
                    found = self._run(connection, statement, statement.expect is not None)
                    if statement.expect is not None and found != statement.expect:
                        raise LedgerConflict(f"{found} instead of {statement.expect}: {statement.sql}")
                connection.commit()
            except BaseException:
                connection.rollback()
                raise
        finally:
            connection.close()

    def number(self, query: str, values: tuple[Any, ...]) -> int:
        connection = self._connection()
        try:
            return self._run(connection, Statement(query, values), query=True)
        finally:
            connection.close()

    def append(self, table: str, rows: DataFrame) -> None:
        rows.write.format("jdbc").options(**jdbc_options(self.cfg), dbtable=table).mode("append").save()

    def read(self, query: str, parts: int) -> DataFrame:
        return self.spark.read.format("jdbc").options(**read_options(self.cfg, query, parts)).load()


def _named(batch: str) -> str:
    if not BATCH_NAME.fullmatch(batch):
        raise ValueError(f"not a batch name: {batch!r}")
    return batch


def _keys_of(batch: str, attempt: str) -> str:
    return f"batch = '{_named(batch)}' AND attempt = '{_named(attempt)}'"


def logged_query(batch: str, attempt: str) -> str:
    """The batch's event ids that the log holds."""
    return (
        f"SELECT k.event_id, k.part FROM (SELECT DISTINCT event_id, part FROM lookup_events WHERE {_keys_of(batch, attempt)}) k "
        "JOIN checkin_events e ON e.event_id = k.event_id"
    )


def daily_query(batch: str, attempt: str, dates: DateRange) -> str:
    """Daily rows of the batch's users, in the months of the batch."""
    columns = ", ".join(f"d.{name}" for name in ledger_columns("daily_checkin"))
    return (
        f"SELECT {columns}, k.part FROM (SELECT DISTINCT user_id, part FROM lookup_users WHERE {_keys_of(batch, attempt)}) k "
        f"JOIN daily_checkin d ON d.user_id = k.user_id WHERE d.checkin_date BETWEEN DATE '{dates[0]}' AND DATE '{dates[1]}'"
    )


def users_query(batch: str, attempt: str) -> str:
    """The batch's users that have a row."""
    return (
        f"SELECT u.id, k.part FROM (SELECT DISTINCT user_id, part FROM lookup_users WHERE {_keys_of(batch, attempt)}) k "
        "JOIN users u ON u.id = k.user_id"
    )


def _delete(table: str, batch: str) -> Statement:
    return Statement(f"DELETE FROM {table} WHERE batch = ?", (batch,))


_STAGED = "WHERE batch = ? AND attempt = ?"


def apply_statements(batch: str, attempt: str) -> list[Statement]:
    """What applies one attempt's staged rows, in this order, in one
    transaction. A task of Spark's writer that ran twice may have staged rows
    twice, so distinct rows are taken; users and days, and event ids, occur once
    in a batch."""
    mine = (batch, attempt)
    days = f"(SELECT DISTINCT * FROM staged_daily_checkin {_STAGED}) s"
    daily, history, log = (", ".join(f"`{c}`" for c in ledger_columns(t)) for t in ("daily_checkin", "user_points_history", "checkin_events"))
    points = f"(SELECT user_id, SUM(points_earned) AS points, MAX(created_at) AS at FROM {days} GROUP BY user_id) p"
    return [
        Statement("INSERT INTO applied_batches (batch, applied_at) VALUES (?, CURRENT_TIMESTAMP)", (batch,)),
        Statement(f"SELECT COUNT(*) FROM {points} LEFT JOIN users u ON u.id = p.user_id WHERE u.id IS NULL", mine, expect=0),
        Statement(f"UPDATE users u JOIN {points} ON p.user_id = u.id SET u.total_points = u.total_points + p.points, u.updated_at = p.at", mine),
        Statement(f"INSERT INTO daily_checkin ({daily}) SELECT {daily} FROM {days}", mine),
        Statement(
            f"INSERT INTO user_points_history ({history}) SELECT user_id, points_earned, transaction_type, description, created_at FROM {days}",
            mine,
        ),
        Statement(f"INSERT IGNORE INTO checkin_events ({log}) SELECT DISTINCT {log} FROM staged_checkin_events {_STAGED}", mine),
        _delete("staged_daily_checkin", batch),
        _delete("staged_checkin_events", batch),
    ]


class DatabaseLedger:
    """The ledger for either job. ``parts`` tasks read a batch's lookups."""

    def __init__(self, database: Database, parts: int = 8) -> None:
        self.database = database
        self.parts = parts
        self._attempts: dict[str, str] = {}

    def _append(self, table: str, batch: str, attempt: str, rows: DataFrame) -> None:
        tokens = [F.lit(_named(batch)).alias("batch"), F.lit(attempt).alias("attempt")]
        self.database.append(table, rows.select(*tokens, *rows.columns))

    def _keys(self, checkins: DataFrame, key: str) -> DataFrame:
        part = F.pmod(F.xxhash64(key), F.lit(self.parts)).cast("int")
        return checkins.select(key).distinct().withColumn("part", part)

    def has(self, batch: str) -> bool:
        return self.database.number("SELECT COUNT(*) FROM applied_batches WHERE batch = ?", (batch,)) > 0

    def lookup(self, checkins: DataFrame, dates: DateRange, batch: str) -> tuple[DataFrame, DataFrame]:
        """Daily rows of the batch's users and months, and its logged event ids."""
        attempt = self._attempts[batch] = uuid.uuid4().hex
        self._append("lookup_users", batch, attempt, self._keys(checkins, "user_id"))
        self._append("lookup_events", batch, attempt, self._keys(checkins, "event_id"))
        daily = self.database.read(daily_query(batch, attempt, dates), self.parts)
        logged = self.database.read(logged_query(batch, attempt), self.parts)
        return daily.select(*ledger_columns("daily_checkin")), logged.select("event_id")

    def known_users(self, checkins: DataFrame, batch: str) -> DataFrame:
        """``id`` of the batch's users; their keys were written by ``lookup``."""
        if batch not in self._attempts:
            return checkins.sparkSession.createDataFrame([], "id bigint")
        return self.database.read(users_query(batch, self._attempts[batch]), self.parts).select("id")

    def append(self, changes: LedgerChanges, now: Column, batch: str) -> None:
        """Stage a batch's changes and apply them, unless that was done."""
        if self.has(batch):
            return
        attempt = uuid.uuid4().hex
        days = changes.daily_checkin.select(
            *ledger_columns("daily_checkin"),
            F.lit(HISTORY_TYPE).alias("transaction_type"),
            history_description(F.col("checkin_order")).alias("description"),
        )
        self._append("staged_daily_checkin", batch, attempt, days)
        log = changes.checkin_events.select(*ledger_columns("checkin_events"))
        self._append("staged_checkin_events", batch, attempt, log)
        self.database.transaction(apply_statements(batch, attempt))

    def release(self, batch: str) -> None:
        """Remove the keys of a finished batch, of all its attempts."""
        self._attempts.pop(batch, None)
        self.database.transaction([_delete("lookup_users", batch), _delete("lookup_events", batch)])
