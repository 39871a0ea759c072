"""Record and table schemas. Wire names are camelCase, columns snake_case."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, order and types of the two wire records.
METADATA_WIRE_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("requestId", T.StringType()),
        T.StructField("clientIp", T.StringType()),
        T.StructField("userAgent", T.StringType()),
    ]
)

CHECKIN_WIRE_SCHEMA = T.StructType(
    [
        T.StructField("eventId", T.StringType()),
        T.StructField("userId", T.LongType()),
        T.StructField("checkinDate", T.DateType()),
        T.StructField("eventTimestamp", T.TimestampNTZType()),
        T.StructField("yearMonth", T.StringType()),
        T.StructField("metadata", METADATA_WIRE_SCHEMA),
    ]
)

TRANSACTION_WIRE_FIELDS = {
    "transactionId": "transaction_id",
    "eventId": "event_id",
    "userId": "user_id",
    "checkinDate": "checkin_date",
    "yearMonth": "year_month",
    "pointsEarned": "points_earned",
    "checkinOrder": "checkin_order",
    "eventTimestamp": "event_timestamp",
    "processedAt": "processed_at",
    "metadata": "metadata",
}

METADATA_FIELDS = {
    "source": "source",
    "version": "version",
    "requestId": "request_id",
    "clientIp": "client_ip",
    "userAgent": "user_agent",
}

METADATA_DDL = (
    "struct<source:string,version:string,request_id:string,"
    "client_ip:string,user_agent:string>"
)

CHECKIN_FIELDS = (
    "event_id",
    "user_id",
    "checkin_date",
    "event_timestamp",
    "year_month",
    "metadata",
)

# A check-in with its place in the arrival order.
CHECKIN_COLUMNS = (*CHECKIN_FIELDS, "arrival_seq")

PROCESSED_COLUMNS = (
    "event_id",
    "user_id",
    "checkin_date",
    "event_timestamp",
    "year_month",
    "points_earned",
    "checkin_order",
    "duplicate",
    "error_message",
)

CHECKIN_DDL = (
    "event_id string, user_id bigint, checkin_date date, "
    "event_timestamp timestamp_ntz, year_month string, "
    f"metadata {METADATA_DDL}, arrival_seq bigint"
)

# Rows as a message broker hands them over.
RAW_RECORD_DDL = "key string, value string, partition int, offset bigint"

# Ledger tables: the columns the job reads or writes.
LEDGER_DDL = {
    "users": "id bigint, total_points bigint, updated_at timestamp_ntz",
    "daily_checkin": (
        "user_id bigint, checkin_date date, points_earned int, "
        "checkin_order int, created_at timestamp_ntz"
    ),
    "user_points_history": (
        "user_id bigint, points int, transaction_type string, "
        "description string, created_at timestamp_ntz"
    ),
    "checkin_events": (
        "event_id string, user_id bigint, checkin_date date, "
        "event_timestamp timestamp_ntz, year_month string, points_earned int, "
        "processed boolean, processed_at timestamp_ntz, error_message string, "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
}


def ledger_columns(table: str) -> list[str]:
    return T.StructType.fromDDL(LEDGER_DDL[table]).fieldNames()
