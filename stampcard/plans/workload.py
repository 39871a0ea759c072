"""Check-ins and ledger tables derived from the ``events`` and ``customer``
tables, for the registered queries, the benchmark and the tests.

Every event is a check-in. Some also arrive again, as real sources deliver
them: purchases a second time unchanged; clicks a second time with the date
moved by a month; errors a second time under the next user. Check-ins before
``LEDGER_CUT`` are in the ledger already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stampcard.config import EngineConfig
from stampcard.functions.rules import points_for_order, quota_month
from stampcard.schemas import METADATA_DDL, METADATA_FIELDS

LEDGER_CUT = "2024-01-08"
NOW = "2024-02-15 12:00:00.250"
#: How long after its event the last copy of it arrives.
LATEST_COPY = 3007


def now():
    """A fixed clock: results that carry it can be compared."""
    return F.lit(NOW).cast("timestamp_ntz")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _base(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.concat(F.lit("E"), F.col("event_id")).alias("event_id"),
        "user_id",
        F.to_date("ts").alias("checkin_date"),
        F.col("ts").alias("event_timestamp"),
        F.date_format("ts", "yyyy-MM").alias("year_month"),
        F.struct(
            F.lit("app").alias("source"),
            F.lit("1").alias("version"),
            F.col("event_id").cast("string").alias("request_id"),
            F.lit(None).cast("string").alias("client_ip"),
            F.lit(None).cast("string").alias("user_agent"),
        ).alias("metadata"),
        (F.col("event_id") * 10).alias("arrival_seq"),
        "event_type",
    )


def _copy(users: int, days: int, arrivals: int):
    return F.struct(
        F.lit(users).alias("users"), F.lit(days).alias("days"), F.lit(arrivals).alias("arrivals")
    )


def checkins_of(raw: DataFrame) -> DataFrame:
    """Check-ins of an events frame, batch or stream, in one pass over it."""
    original = _copy(0, 0, 0)
    copies = (
        F.when(F.col("event_type") == "purchase", F.array(original, _copy(0, 0, 1005)))
        .when(F.col("event_type") == "click", F.array(original, _copy(0, 30, LATEST_COPY)))
        .when(F.col("event_type") == "error", F.array(original, _copy(1, 0, 2003)))
        .otherwise(F.array(original))
    )
    return (
        _base(raw)
        .withColumn("copy", F.explode(copies))
        .select(
            "event_id",
            (F.col("user_id") + F.col("copy.users")).alias("user_id"),
            F.date_add("checkin_date", F.col("copy.days")).alias("checkin_date"),
            "event_timestamp",
            "year_month",
            "metadata",
            (F.col("arrival_seq") + F.col("copy.arrivals")).alias("arrival_seq"),
        )
    )


def _logged(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("ts") < F.lit(LEDGER_CUT).cast("timestamp_ntz"))


def checkin_days_of(checkins: DataFrame) -> DataFrame:
    """One row per user and day of all check-ins."""
    return checkins.select("user_id", "checkin_date").distinct()


def daily_checkin_of(raw: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The ledger's daily rows: one per user and day before the cut, up to the
    monthly quota, as a job with that quota would have left them."""
    days = _base(_logged(raw)).select("user_id", "checkin_date").distinct()
    month = Window.partitionBy("user_id", quota_month(F.col("checkin_date"))).orderBy("checkin_date")
    return (
        days.withColumn("checkin_order", F.row_number().over(month))
        .filter(F.col("checkin_order") <= F.lit(cfg.max_per_month))
        .select(
            "user_id",
            "checkin_date",
            points_for_order(F.col("checkin_order"), cfg.points_ladder).alias("points_earned"),
            "checkin_order",
            F.col("checkin_date").cast("timestamp_ntz").alias("created_at"),
        )
    )


def checkin_events_of(raw: DataFrame) -> DataFrame:
    """Log of the check-ins before the cut."""
    time = F.col("event_timestamp")
    return _base(_logged(raw)).select(
        "event_id",
        "user_id",
        "checkin_date",
        "event_timestamp",
        "year_month",
        F.lit(1).alias("points_earned"),
        F.lit(True).alias("processed"),
        time.alias("processed_at"),
        F.lit(None).cast("string").alias("error_message"),
        time.alias("created_at"),
        time.alias("updated_at"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customer.select(
        F.col("c_custkey").alias("id"),
        F.lit(0).cast("bigint").alias("total_points"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )


def users_in_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as if accounts with a debt had been closed."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("id"))


def order_checkins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as check-ins: many months, one event per order."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(
        F.concat(F.lit("O"), F.col("o_orderkey")).alias("event_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("checkin_date"),
        F.col("o_orderdate").alias("event_timestamp"),
        F.date_format("o_orderdate", "yyyy-MM").alias("year_month"),
        F.lit(None).cast(METADATA_DDL).alias("metadata"),
        F.col("o_orderkey").alias("arrival_seq"),
    )


def checkin_json() -> Column:
    """Wire JSON of a check-in row."""
    metadata = [F.col(f"metadata.{name}").alias(field) for field, name in METADATA_FIELDS.items()]
    return F.to_json(
        F.struct(
            F.col("event_id").alias("eventId"),
            F.col("user_id").alias("userId"),
            F.col("checkin_date").alias("checkinDate"),
            F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("eventTimestamp"),
            F.col("year_month").alias("yearMonth"),
            F.struct(*metadata).alias("metadata"),
        )
    )


def damaged_records_of(raw: DataFrame) -> DataFrame:
    """Every event as a raw record, in odd forms or damaged by event type and
    by the range its ``value`` lies in."""
    kind = F.col("event_type")
    amount = F.col("value")
    number = F.col("event_id").cast("string")
    user = F.col("user_id").cast("string")
    date = F.date_format("ts", "yyyy-MM-dd")
    value = (
        F.when((kind == "view") & (amount < 20), F.lit(None))
        .when((kind == "view") & (amount < 40), F.lit("  "))
        .when((kind == "view") & (amount < 60), F.lit("null"))
        .when(
            kind == "view",
            F.format_string('{"eventId":"E%s","userId":%s,"checkinDate":"%s","extra":[1]}', number, user, date),
        )
        .when(
            (kind == "click") & (amount < 60),
            F.format_string('{"eventId":"E%s","userId":"%s","checkinDate":"%s"}', number, user, date),
        )
        .when(
            kind == "click",
            F.format_string('{"eventId":%s,"userId":%s,"checkinDate":"%s"}', number, user, date),
        )
        .when(
            (kind == "purchase") & (amount < 60),
            F.format_string('{"userId":%s,"checkinDate":"%s"}', user, date),
        )
        .when(kind == "purchase", F.format_string('{"eventId":"E%s","checkinDate":"%s"}', number, date))
        .when(
            (kind == "signup") & (amount < 60),
            F.format_string('{"eventId":"E%s","userId":%s}', number, user),
        )
        .when(
            (kind == "signup") & (amount < 75),
            F.format_string(
                '{"eventId":"E%s","userId":%s.75,"checkinDate":[%s],"eventTimestamp":"%sT10:00:00Z"}',
                number,
                user,
                F.date_format("ts", "yyyy,M,d"),
                date,
            ),
        )
        .when(
            kind == "signup",
            F.format_string(
                '{"eventId":"E%s","userId":%s,"checkinDate":"%s","eventTimestamp":"%sT10:00:00+07:00"}',
                number,
                user,
                date,
                date,
            ),
        )
        .otherwise(F.format_string('{"eventId":"E%s","userId":%s', number, user))
    )
    return raw.select(
        value.alias("value"), (F.col("event_id") * 10).alias("arrival_seq")
    )
