"""What the plans must look like for data that does not fit one task."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from stampcard import EngineConfig
from stampcard.operators.decide import accept, decide, settle
from stampcard.operators.dedup import first_per_key
from stampcard.operators.ledger import day_winners, event_log_rows, same_day_guard
from stampcard.operators.lookups import mark_ledger_duplicates
from stampcard.plans import registry
from stampcard.plans import workload as W
from stampcard.sources.tables import FileLedger, month_range
from stampcard.streaming.bounded import ranges

SMALL_SPLITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}
CFG = EngineConfig()
N = 120_000


@pytest.fixture
def small_splits(spark):
    before = {name: spark.conf.get(name, None) for name in SMALL_SPLITS}
    for name, value in SMALL_SPLITS.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def skewed_checkins(spark, root):
    """A third copies of one event, a third one user's own events, a third one
    event id under many users."""
    third = F.col("id") % 3
    rows = spark.range(0, N, 1, 8).select(
        F.when(third == 0, F.lit("copied"))
        .when(third == 1, F.concat(F.lit("own"), F.col("id")))
        .otherwise(F.lit("shared"))
        .alias("event_id"),
        F.when(third == 2, F.col("id")).otherwise(F.lit(1)).alias("user_id"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 28).cast("int")).alias("checkin_date"),
        F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("event_timestamp"),
        F.lit("2024-01").alias("year_month"),
        F.struct(*[F.lit(None).cast("string").alias(c) for c in
                   ("source", "version", "request_id", "client_ip", "user_agent")]).alias("metadata"),
        F.col("id").alias("arrival_seq"),
    )
    rows.write.parquet(f"{root}/checkins")
    return spark.read.parquet(f"{root}/checkins")


def ledger_frames(spark):
    daily = spark.range(1).selectExpr("1L AS user_id", "date'2024-01-01' AS checkin_date")
    logged = spark.range(100).selectExpr("concat('old', id) AS event_id")
    return daily, logged


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("mode", ["snapshot", "sequential"])
def test_hot_keys_are_split_and_results_are_whole(small_splits, tmp_path, mode):
    checkins = skewed_checkins(small_splits, tmp_path)
    daily, logged = ledger_frames(small_splits)
    decided = decide(checkins, daily, logged, CFG.with_(order_mode=mode))
    counts = Counter(r.status for r in decided.select("arrival_seq", "status").collect())
    third = N // 3
    if mode == "snapshot":
        assert counts == {"ACCEPT": 1 + 2 * third, "DUP_STATE": third - 1}
    else:  # user 1 has room for six events, of which the copied one is the first
        assert counts == {"ACCEPT": 6 + third, "DUP_STATE": third - 1, "LIMIT": third - 5}
    decided.collect()
    # The last join, of the records with their verdicts, is the one to split.
    joins = re.findall(r"\w*Join(?:\(skew=true\))?", final_plan(decided))
    assert joins[0] == "SortMergeJoin(skew=true)"


def test_hot_keys_of_the_ledger_lookup_are_split(small_splits, tmp_path):
    checkins = skewed_checkins(small_splits, tmp_path)
    _, logged = ledger_frames(small_splits)

    marked = mark_ledger_duplicates(
        checkins.select("event_id", "arrival_seq"), logged, ["arrival_seq"]
    )
    assert marked.filter("in_ledger").count() == 0
    marked.collect()
    assert "skew=true" in final_plan(marked)


@pytest.mark.parametrize("mode", ["snapshot", "sequential"])
def test_hot_keys_in_the_live_path(small_splits, tmp_path, mode):
    checkins = skewed_checkins(small_splits, tmp_path)
    daily, logged = ledger_frames(small_splits)
    cfg = CFG.with_(order_mode=mode)
    accepted = accept(checkins, daily, logged, cfg)
    third = N // 3
    # User 1 has one check-in in the ledger, so six of the hot user's events
    # fit in sequential mode; the shared id is one event of each other user.
    assert len(accepted.collect()) == third + (third + 1 if mode == "snapshot" else 6)
    if mode == "sequential":
        # Verdicts are settled in tables of their own, and what is accepted is
        # joined by arrival, which no two records share.
        return
    # Joins are split. Below every shuffle by user and event the copies are
    # folded, and below every shuffle by user and month the ranks are limited.
    plan = final_plan(accepted)
    assert "skew=true" in plan and "partial_min_by" in plan


def test_hot_day_reaches_one_task_as_few_rows(small_splits, tmp_path):
    """The ledger operators limit each key before the shuffle."""
    checkins = skewed_checkins(small_splits, tmp_path)
    daily, logged = ledger_frames(small_splits)
    processed = checkins.select(
        "event_id", "user_id", "checkin_date", "event_timestamp", "year_month", "arrival_seq",
        F.lit(1).alias("points_earned"), F.lit(1).alias("checkin_order"),
        F.lit(False).alias("duplicate"), F.lit(None).cast("string").alias("error_message"),
    )
    winners = day_winners(processed, daily)
    hot_days = {r.checkin_date for r in winners.filter("user_id = 1").collect()}
    assert len(hot_days) == 27
    winners.collect()
    assert "partial_min_by" in final_plan(winners)
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    log = event_log_rows(processed, winners, logged, now)
    assert log.count() == N // 3 + 2
    guarded = same_day_guard(processed, daily)
    assert guarded.count() == N


HEAVY = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonEval", "MapInArrow", "MapInPandas")


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if "stream" not in n))
def test_plans_stay_in_the_jvm_without_cross_joins(spark, sf_dir, name):
    plan = contract.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in HEAVY if word in plan]


def test_scans_read_needed_columns_and_push_filters(spark, sf_dir):
    df = contract.queries()["monthly_counts"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    log = contract.queries()["ledger_duplicates"](spark, sf_dir)
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(ts,2024-01-08", plan)
    metrics = contract.queries()["decision_metrics"](spark, sf_dir)
    plan = metrics._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "value" not in plan


def test_ledger_reads_are_bound_to_the_months_of_the_batch(spark, tmp_path):
    days = spark.range(1, 400).selectExpr(
        "id AS user_id", "date_add(date'2023-01-01', int(id)) AS checkin_date",
        "1 AS points_earned", "1 AS checkin_order", "CAST(NULL AS timestamp_ntz) AS created_at",
    )
    users = spark.range(1).selectExpr("id", "0L AS total_points", "CAST(NULL AS timestamp_ntz) AS updated_at")
    events = spark.createDataFrame([], "event_id string, user_id bigint, checkin_date date, "
        "event_timestamp timestamp_ntz, year_month string, points_earned int, processed boolean, "
        "processed_at timestamp_ntz, error_message string, created_at timestamp_ntz, updated_at timestamp_ntz")
    ledger = FileLedger(spark, str(tmp_path)).create(users, days, events)
    batch = days.filter("checkin_date between '2023-02-10' and '2023-03-05'")
    dates = month_range(batch)
    assert [str(d) for d in dates] == ["2023-02-01", "2023-03-31"]
    read = ledger.daily_checkin(dates, skip_batch="q-1")
    assert read.count() == 28 + 31
    scan = read._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    bound = re.search(r"PartitionFilters: \[(.*)\]", scan).group(1)
    assert "quota_month" in bound
    assert month_range(days.limit(0)) is None


def test_first_rows_of_plain_columns_are_hashed(spark):
    rows = spark.createDataFrame(
        [(1, "a", 5, None), (1, "a", 3, 30), (1, "a", 4, 40), (2, "a", None, 7), (2, "b", 9, None)],
        "user_id bigint, event_id string, first_arrival bigint, month_count bigint",
    )
    first = first_per_key(rows, ["user_id", "event_id"], "first_arrival")
    assert first.columns == rows.columns
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()
    # As with a struct, a key without an order has nulls.
    assert sorted(map(tuple, first.collect())) == [(1, "a", 3, 30), (2, "a", None, None), (2, "b", 9, None)]


def test_later_rounds_read_open_copies_only(spark, tmp_path):
    months = [(1, f"E{n}", month, 0, n + 100 * (month == "2024-02-01")) for n in range(30) for month in ("2024-01-01", "2024-02-01")]
    ruled = spark.createDataFrame(
        [(*row, False, False) for row in months],
        "user_id bigint, event_id string, quota_month string, month_count bigint, first_arrival bigint, in_ledger boolean, in_state boolean",
    ).selectExpr("* EXCEPT (quota_month)", "CAST(quota_month AS date) AS quota_month", "first_arrival AS first_mark")
    tables = []

    def cut(df):
        df.write.parquet(f"{tmp_path}/{len(tables)}")
        tables.append(spark.read.parquet(f"{tmp_path}/{len(tables)}"))
        return tables[-1]

    settled = settle(ruled, CFG.with_(order_mode="sequential"), cut)
    quota = CFG.max_per_month
    taken = {(r.event_id, r.first_mark) for r in settled.collect() if r.first_arrival == r.first_mark}
    assert taken == {(f"E{n}", n) for n in range(quota)} | {(f"E{n}", n + 100) for n in range(quota, 2 * quota)}
    opened = [t for t in tables if "event_id" in t.columns]
    # Of the 30 copies of the first month, those beyond its quota are out.
    assert [t.count() for t in opened] == [30 + quota]


def test_ranges_of_a_stream_read_the_events_they_need(spark, tmp_path):
    kinds = ("click", "error", "purchase", "view")
    events = spark.range(3000).selectExpr(
        "nullif(id, 7) AS event_id", "CAST('2024-01-05 10:00:00' AS timestamp_ntz) AS ts", "id % 9 AS user_id",
        f"element_at(array{kinds}, CAST(id % 4 AS int) + 1) AS event_type", "1.0D AS value",
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    raw = W.events(spark, str(tmp_path))
    arrivals = [r.arrival_seq for r in W.checkins_of(raw).collect() if r.arrival_seq is not None]
    cuts = [(-1, 14995), (14995, 16495), (16495, 10**9)]
    parts = ranges(raw)
    for (low, high), part in zip(cuts, parts, strict=True):
        assert "event_id" in part._jdf.queryExecution().executedPlan().toString().partition("PushedFilters")[2].partition("]")[0]
        assert sorted(r.arrival_seq for r in part.collect()) == sorted(a for a in arrivals if low <= a < high)
