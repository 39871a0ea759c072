"""Ledger tables kept as parquet files, and the journal of a stream's batches."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from stampcard.functions.rules import quota_month
from stampcard.operators.ledger import LedgerChanges, user_balances
from stampcard.operators.lookups import matching
from stampcard.schemas import LEDGER_DDL, ledger_columns
from stampcard.session import remove_path

DateRange = tuple[dt.date, dt.date]

# Rows that were in the ledger before any stream wrote to it.
INITIAL = "initial"

USER_POINTS_DDL = "user_id bigint, points_added bigint, added_at timestamp_ntz"


def month_range(checkins: DataFrame) -> DateRange | None:
    """First day of the first and last day of the last quota month of a batch;
    None for a batch without rows. Two values, whatever the batch's size."""
    month = quota_month(F.col("checkin_date"))
    row = checkins.agg(
        F.min(month).alias("first"), F.last_day(F.max(month)).alias("last")
    ).head()
    return None if row.first is None else (row.first, row.last)


def in_range(df: DataFrame, dates: DateRange | None) -> DataFrame:
    """Bound by plain date comparisons, which reach the scan; ``year(...)``
    and ``month(...)`` comparisons would not."""
    if dates is None:
        return df
    return df.filter(F.col("checkin_date").between(F.lit(dates[0]), F.lit(dates[1])))


#: What the ledger says of a folder of rows: how often its rows were merged
#: (-1: the starting tables, never merged), whose folders it takes the place
#: of, and the last batch of each query that it holds.
ENTRY_DDL = "batch string, level int, replaces array<string>, upto map<string,bigint>"
NUMBERED = re.compile(r"(.*)-(\d+)")


class FileLedger:
    """The four tables as parquet, one folder per table and batch.

    A batch counts from the moment its entry is written, one small file after
    all of its tables: readers take the folders that entries name, so a batch
    half written is never seen, and one that has its entry is not written again.
    ``pinned`` fixes what is read for a reader of several tables. Users' points
    are kept as what each batch added; the balance is the sum, and no batch
    rewrites the users table.

    ``merge_batches`` keeps the number of folders small while a stream runs. One
    job writes to a ledger at a time.
    """

    TABLES = ("users", "daily_checkin", "checkin_events", "user_points_history", "user_points")

    def __init__(self, spark: SparkSession, root: str, batches: list[str] | None = None) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self._batches = batches

    def _path(self, table: str, batch: str) -> str:
        return f"{self.root}/{table}/batch={batch}"

    def _write(self, table: str, rows: DataFrame, batch: str) -> None:
        path = self._path(table, batch)
        if table == "daily_checkin":
            monthly = rows.withColumn("quota_month", quota_month(F.col("checkin_date")))
            monthly.write.mode("overwrite").partitionBy("quota_month").parquet(path)
        else:
            rows.write.mode("overwrite").parquet(path)

    def _entries(self) -> list[Row]:
        """One row per folder that counts, or has counted until the last merge."""
        reader = self.spark.read.schema(ENTRY_DDL).option("recursiveFileLookup", "true")
        return reader.parquet(f"{self.root}/entries").collect()

    def _enter(self, batch: str, level: int = 0, replaces: list[str] | None = None, upto: dict[str, int] | None = None) -> None:
        if upto is None:
            named = NUMBERED.fullmatch(batch)
            upto = {named[1]: int(named[2])} if named else {}
        row = self.spark.createDataFrame([(batch, level, replaces or [], upto)], ENTRY_DDL)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/entries/{batch}")

    def batches(self) -> list[str]:
        """Folders that count now: a few for each level of merging."""
        if self._batches is not None:
            return self._batches
        entries = self._entries()
        gone = {name for entry in entries for name in entry.replaces}
        return sorted(entry.batch for entry in entries if entry.batch not in gone)

    def pinned(self) -> FileLedger:
        """The ledger as it is now, whatever is added later: all tables read
        from it are of one moment."""
        return FileLedger(self.spark, self.root, self.batches())

    def has(self, batch: str) -> bool:
        """Whether a batch was applied, by itself or in a merged folder."""
        named = NUMBERED.fullmatch(batch)
        return any(
            entry.batch == batch or (named is not None and entry.upto.get(named[1], -1) >= int(named[2]))
            for entry in self._entries()
        )

    def _read(self, table: str, ddl: str, skip_batch: str | None = None, only: list[str] | None = None) -> DataFrame:
        names = [b for b in (self.batches() if only is None else only) if b != skip_batch]
        paths = [self._path(table, b) for b in names if table != "users" or b == INITIAL]
        reader = self.spark.read.schema(f"{ddl}, batch string").option("basePath", f"{self.root}/{table}")
        return reader.parquet(*paths)

    def create(
        self,
        users: DataFrame,
        daily_checkin: DataFrame,
        checkin_events: DataFrame,
        user_points_history: DataFrame | None = None,
    ) -> FileLedger:
        """Write the tables a stream starts from."""
        if user_points_history is None:
            user_points_history = self.spark.createDataFrame(
                [], LEDGER_DDL["user_points_history"]
            )
        self._write("users", users, INITIAL)
        self._write("daily_checkin", daily_checkin, INITIAL)
        self._write("checkin_events", checkin_events, INITIAL)
        self._write("user_points_history", user_points_history, INITIAL)
        self._write("user_points", self.spark.createDataFrame([], USER_POINTS_DDL), INITIAL)
        self._enter(INITIAL, level=-1)
        return self

    def append(self, changes: LedgerChanges, now: Column, batch: str) -> None:
        """Add a batch's changes; a batch that was applied stays as it is."""
        if self.has(batch):
            return
        self._write("daily_checkin", changes.daily_checkin, batch)
        self._write("user_points_history", changes.user_points_history, batch)
        self._write("checkin_events", changes.checkin_events, batch)
        self._write("user_points", changes.user_points.withColumn("added_at", now), batch)
        self._enter(batch)

    def daily_checkin(
        self, dates: DateRange | None = None, skip_batch: str | None = None
    ) -> DataFrame:
        rows = self._read(
            "daily_checkin", LEDGER_DDL["daily_checkin"] + ", quota_month date", skip_batch
        )
        if dates is not None:
            rows = rows.filter(F.col("quota_month").between(F.lit(dates[0]), F.lit(dates[1])))
        return rows.select(*ledger_columns("daily_checkin"))

    def checkin_events(self, skip_batch: str | None = None) -> DataFrame:
        rows = self._read("checkin_events", LEDGER_DDL["checkin_events"], skip_batch)
        return rows.select(*ledger_columns("checkin_events"))

    def user_points_history(self, skip_batch: str | None = None) -> DataFrame:
        rows = self._read("user_points_history", LEDGER_DDL["user_points_history"], skip_batch)
        return rows.select(*ledger_columns("user_points_history"))

    def lookup(self, checkins: DataFrame, dates: DateRange, batch: str) -> tuple[DataFrame, DataFrame]:
        """Daily rows of the batch's users and months, and its logged event ids."""
        view = self.pinned()
        daily = matching(view.daily_checkin(dates), checkins, "user_id")
        return daily, matching(view.checkin_events().select("event_id"), checkins, "event_id")

    def known_users(self, checkins: DataFrame, batch: str) -> DataFrame:
        """``id`` of the batch's users that have a row in ``users``."""
        users = self._read("users", LEDGER_DDL["users"], only=[INITIAL]).select("id")
        return matching(users, checkins, "id", "user_id")

    def release(self, batch: str) -> None:
        """Nothing is kept for a batch here."""

    def users(self, skip_batch: str | None = None) -> DataFrame:
        """Balances: starting points plus all that was added."""
        start = self._read("users", LEDGER_DDL["users"], only=[INITIAL]).drop("batch")
        added = self._read("user_points", USER_POINTS_DDL, skip_batch)
        return user_balances(start, self._sums(added), F.col("added_at"))

    @staticmethod
    def _sums(added: DataFrame) -> DataFrame:
        return added.groupBy("user_id").agg(
            F.sum("points_added").alias("points_added"), F.max("added_at").alias("added_at")
        )

    def merge_batches(self, fan_in: int = 8) -> list[str]:
        """Write the folders of ``fan_in`` batches as one, and of as many merged
        ones again, so a row is rewritten a few times only and folders stay few.

        Call it between two batches. Folders of the merge before are removed
        now; a reader that started since then does not use them. Returns the
        names of the new folders.
        """
        entries = self._entries()
        gone = {name for entry in entries for name in entry.replaces}
        for name in sorted(gone):
            for table in self.TABLES:
                remove_path(self.spark, self._path(table, name))
        kept = [entry for entry in entries if entry.batch not in gone]
        levels = defaultdict(list)
        for entry in kept:
            levels[entry.level].append(entry)
        merged = []
        for level, group in sorted(levels.items()):
            if level >= 0 and len(group) >= fan_in:
                merged.append(self._merge(group, level + 1))
        for name in sorted(gone):
            remove_path(self.spark, f"{self.root}/entries/{name}")
        return merged

    def _merge(self, group: list[Row], level: int) -> str:
        name = f"merged{level}_{uuid.uuid4().hex}"
        old = [entry.batch for entry in group]
        for table in self.TABLES[1:4]:
            ddl = LEDGER_DDL[table] + ", quota_month date" * (table == "daily_checkin")
            self._write(table, self._read(table, ddl, only=old).select(*ledger_columns(table)), name)
        self._write("user_points", self._sums(self._read("user_points", USER_POINTS_DDL, only=old)), name)
        upto: dict[str, int] = {}
        for entry in group:
            for query, number in entry.upto.items():
                upto[query] = max(number, upto.get(query, -1))
        self._enter(name, level, old, upto)
        return name

    def rebase(self, root: str) -> FileLedger:
        """Copy the present contents to a new place as its starting tables."""
        view = self.pinned()
        return FileLedger(self.spark, root).create(
            view.users(), view.daily_checkin(), view.checkin_events(), view.user_points_history()
        )


class BatchJournal:
    """What a stream remembers of each batch besides its rows: which steps
    are done, and the clock it first ran under, so a repeat stamps equal
    times. One tiny file per step; a query repeats its last batch only, so the
    notes of batches long done are removed."""

    #: Batches back to which notes are kept.
    KEPT = 8

    DDL = "at timestamp_ntz"

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = f"{root.rstrip('/')}/batches"
        empty = spark.createDataFrame([], self.DDL)
        empty.write.mode("ignore").parquet(f"{self.root}/empty")

    def time_of(self, batch: str, step: str) -> dt.datetime | None:
        """The clock a step was noted with; None if it was not reached."""
        # A pattern may match less than it names; a missing path is an error.
        # Spark looks into a single path for a stream's log, but not into two.
        pattern = f"{self.root}/{{empty,{batch}.{step}}}"
        row = self.spark.read.schema(self.DDL).parquet(f"{self.root}/empty", pattern).head()
        return None if row is None else row.at

    def note(self, batch: str, step: str, at: dt.datetime) -> None:
        one = self.spark.range(0, 1, 1, 1).select(
            F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz").alias("at")
        )
        one.write.mode("overwrite").parquet(f"{self.root}/{batch}.{step}")

    def clock(self, batch: str, now: dt.datetime) -> dt.datetime:
        """The batch's time: ``now`` on its first run, the same ever after."""
        earlier = self.time_of(batch, "started")
        if earlier is not None:
            return earlier
        self.note(batch, "started", now)
        return now

    def forget_before(self, batch: str) -> None:
        """Remove the notes of the batch ``KEPT`` before this one."""
        named = NUMBERED.fullmatch(batch)
        if named is not None and int(named[2]) >= self.KEPT:
            for step in ("started", "ruled", "finished"):
                remove_path(self.spark, f"{self.root}/{named[1]}-{int(named[2]) - self.KEPT}.{step}")
