import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stampcard import EngineConfig
from stampcard.functions.rules import to_transactions
from stampcard.sources.wire import decode_checkins, kafka_records, split_quarantine

FULL = json.dumps(
    {
        "eventId": "a",
        "userId": 1,
        "checkinDate": "2024-01-05",
        "eventTimestamp": "2024-01-05T10:11:12.123456789",
        "yearMonth": "2024-01",
        "metadata": {"source": "app", "version": "2", "requestId": "r", "clientIp": None},
        "extra": {"x": [1]},
    }
)


def with_fields(**fields):
    record = {"eventId": "a", "userId": 1, "checkinDate": "2024-01-05"}
    record.update(fields)
    return json.dumps(record)


FAULTS = {
    with_fields(userId="12"): "MALFORMED",
    with_fields(userId=1.5): "MALFORMED",
    with_fields(checkinDate=[2024, 1, 5]): "MALFORMED",
    with_fields(eventTimestamp="2024-01-05T10:00:00Z"): "MALFORMED",
    with_fields(eventTimestamp="2024-01-05T10:00:00+07:00"): "MALFORMED",
    "{bad": "MALFORMED",
    "": "MALFORMED",
    "  ": "MALFORMED",
    None: "MALFORMED",
    "null": "NULL_RECORD",
    '{"eventId":"a"}': "NULL_USER_ID",
    with_fields(eventId=None): "NULL_EVENT_ID",
    with_fields(checkinDate=None): "NULL_CHECKIN_DATE",
    with_fields(eventId=7): None,
    with_fields(eventTimestamp="2024-01-05T10:00"): None,
    FULL: None,
}


def raw(spark, values):
    return spark.createDataFrame(
        [(v, k) for k, v in enumerate(values)], "value string, arrival_seq bigint"
    )


FORMS = {
    with_fields(userId="12"): (12, dt.date(2024, 1, 5), None),
    with_fields(userId=1.5): (1, dt.date(2024, 1, 5), None),
    with_fields(userId=-1.5): (-1, dt.date(2024, 1, 5), None),
    with_fields(userId=9007199254740993): (9007199254740993, dt.date(2024, 1, 5), None),
    with_fields(checkinDate=[2024, 1, 5]): (1, dt.date(2024, 1, 5), None),
    with_fields(checkinDate="2024-01-05T10:00:00"): (1, dt.date(2024, 1, 5), None),
    with_fields(eventTimestamp="2024-01-05T10:00:00Z"): (1, dt.date(2024, 1, 5), dt.datetime(2024, 1, 5, 10)),
    with_fields(eventTimestamp="2024-01-05T10:00:01.25Z"): (1, dt.date(2024, 1, 5), dt.datetime(2024, 1, 5, 10, 0, 1, 250_000)),
    with_fields(eventTimestamp=[2024, 1, 5, 9, 7]): (1, dt.date(2024, 1, 5), dt.datetime(2024, 1, 5, 9, 7)),
    with_fields(eventTimestamp=[2024, 1, 5, 9, 7, 3, 5_000_000]): (1, dt.date(2024, 1, 5), dt.datetime(2024, 1, 5, 9, 7, 3, 5000)),
}
NO_FORMS = [
    with_fields(userId="x"), with_fields(userId=True), with_fields(userId=[1]), with_fields(checkinDate=[2024, 1]),
    with_fields(checkinDate=[2024, 2, 30]), with_fields(checkinDate="05.01.2024"), with_fields(userId="99999999999999999999"),
    with_fields(eventTimestamp="2024-01-05T10:00:00+07:00"), with_fields(eventTimestamp=[2024, 1, 5]), with_fields(eventTimestamp="soon"),
]


def test_other_forms_of_a_field(spark):
    rows = decode_checkins(raw(spark, FORMS)).orderBy("arrival_seq").collect()
    assert [(r.user_id, r.checkin_date, r.event_timestamp) for r in rows] == list(FORMS.values())
    bad = decode_checkins(raw(spark, NO_FORMS), on_error="quarantine").collect()
    assert {r.reason for r in bad} == {"MALFORMED"}


def test_faults(spark):
    decoded = decode_checkins(raw(spark, FAULTS), on_error="quarantine", strict=True)
    reasons = {r.arrival_seq: r.reason for r in decoded.collect()}
    assert reasons == dict(enumerate(FAULTS.values()))
    good, bad = split_quarantine(decoded)
    assert good.count() == 3 and bad.count() == len(FAULTS) - 3
    assert set(bad.columns) == {"arrival_seq", "raw", "reason"}
    assert {r.event_id for r in good.collect()} == {"a", "7"}


def test_full_record(spark):
    row = decode_checkins(raw(spark, [FULL])).head()
    assert (row.event_id, row.user_id, row.checkin_date) == ("a", 1, dt.date(2024, 1, 5))
    assert row.event_timestamp == dt.datetime(2024, 1, 5, 10, 11, 12, 123456)
    assert row.metadata.asDict() == {
        "source": "app", "version": "2", "request_id": "r", "client_ip": None, "user_agent": None
    }


def test_missing_metadata_stays_missing(spark):
    assert decode_checkins(raw(spark, [with_fields()])).head().metadata is None


def test_bytes_are_decoded(spark):
    df = raw(spark, [FULL]).withColumn("value", F.col("value").cast("binary"))
    assert decode_checkins(df).head().event_id == "a"


@pytest.mark.parametrize("value", [v for v, r in FAULTS.items() if r not in (None, "NULL_RECORD")])
def test_one_bad_record_fails_the_job(spark, value):
    with pytest.raises(PySparkException, match="unusable check-in record"):
        decode_checkins(raw(spark, [FULL, value]), strict=True).count()


def test_null_record_is_skipped(spark):
    assert decode_checkins(raw(spark, ["null", FULL])).count() == 1


def test_encoded_record(spark):
    checkins = decode_checkins(raw(spark, [FULL, with_fields(userId=2)])).withColumn(
        "checkin_order", F.lit(2)
    )
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    sent = {r.key: r.value for r in kafka_records(to_transactions(checkins, EngineConfig(), at)).collect()}
    record = json.loads(sent["1"])
    assert list(record) == [
        "transactionId", "eventId", "userId", "checkinDate", "yearMonth",
        "pointsEarned", "checkinOrder", "eventTimestamp", "processedAt", "metadata",
    ]
    assert record["checkinDate"] == "2024-01-05"
    assert record["eventTimestamp"] == "2024-01-05T10:11:12.123456"
    assert record["processedAt"] == "2024-02-01T00:00:00"
    assert list(record["metadata"]) == ["source", "version", "requestId", "clientIp", "userAgent"]
    bare = json.loads(sent["2"])
    assert bare["metadata"] is None and bare["eventTimestamp"] is None and bare["yearMonth"] is None
