import datetime as dt

from pyspark.sql import functions as F

from stampcard import EngineConfig
from stampcard.functions.rules import points_for_order, to_transactions, with_quota_month
from stampcard.sources.wire import iso_time



def at():
    return F.lit("2024-01-02 03:04:05.678901").cast("timestamp_ntz")


def test_points_past_the_ladder_stay_at_its_end(spark):
    rows = spark.range(1, 5).select(points_for_order(F.col("id"), (10, 20)).alias("p")).collect()
    assert [r.p for r in rows] == [10, 20, 20, 20]


def test_quota_month_ignores_the_month_text(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29), "2023-12")], "checkin_date date, year_month string")
    assert with_quota_month(df).head().quota_month == dt.date(2024, 2, 1)


def _accepted(spark, year_month):
    return spark.createDataFrame(
        [("e", 7, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2), year_month, None, 3, 0)],
        "event_id string, user_id bigint, checkin_date date, event_timestamp timestamp_ntz, "
        "year_month string, metadata string, checkin_order int, arrival_seq bigint",
    )


def test_transaction_ids(spark):
    cfg = EngineConfig()
    row = to_transactions(_accepted(spark, "2024-01"), cfg, at()).head()
    assert row.transaction_id == "7_2024-01_3_1704164645678"
    assert row.points_earned == 3
    stable = to_transactions(_accepted(spark, "2024-01"), cfg.with_(id_mode="deterministic"), at())
    assert stable.head().transaction_id == "7_2024-01_3_e"


def test_missing_month_text_prints_as_null(spark):
    row = to_transactions(_accepted(spark, None), EngineConfig(), at()).head()
    assert row.transaction_id.startswith("7_null_3_")


def test_default_clock_is_now(spark):
    row = to_transactions(_accepted(spark, "2024-01"), EngineConfig()).head()
    age = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - row.processed_at
    assert abs(age) < dt.timedelta(minutes=5)


def test_iso_time_prints_needed_digits_only(spark):
    times = ["2024-01-02 03:04:05", "2024-01-02 03:04:00.5", "2024-01-02 00:00:00.000001", "2024-01-02 10:00:00.120"]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    out = [r.x for r in df.select(iso_time(F.col("t").cast("timestamp_ntz")).alias("x")).collect()]
    assert out == [
        "2024-01-02T03:04:05",
        "2024-01-02T03:04:00.5",
        "2024-01-02T00:00:00.000001",
        "2024-01-02T10:00:00.12",
    ]
