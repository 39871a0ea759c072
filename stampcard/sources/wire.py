"""JSON wire formats: decoding check-ins, encoding point transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stampcard.schemas import CHECKIN_FIELDS, CHECKIN_WIRE_SCHEMA, METADATA_FIELDS, TRANSACTION_WIRE_FIELDS

# Why a record cannot be used.
MALFORMED = "MALFORMED"
NULL_RECORD = "NULL_RECORD"
NULL_EVENT_ID = "NULL_EVENT_ID"
NULL_USER_ID = "NULL_USER_ID"
NULL_CHECKIN_DATE = "NULL_CHECKIN_DATE"

_CORRUPT = "__corrupt"


#: Fields of which more than one JSON form is taken, unless told otherwise.
_MANY_FORMS = ("userId", "checkinDate", "eventTimestamp")


def _parse(value: Column, strict: bool) -> Column:
    """Wire fields of a JSON text, each record parsed once.

    Given out by a generator, because Spark would copy a plain ``from_json``
    into every filter and field that uses its result. Unless ``strict``, fields
    of many forms are given out as text, a JSON array as its compact text.
    """
    fields = [
        T.StructField(f.name, T.StringType()) if f.name in _MANY_FORMS and not strict else f
        for f in CHECKIN_WIRE_SCHEMA.fields
    ]
    schema = T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return F.inline(F.array(F.from_json(value, schema, options)))


def _long(text: Column) -> Column:
    """A whole number; of a fraction, its whole part."""
    number = F.trim(text)
    return F.when(number.rlike(r"^[+-]?\d+$"), number.try_cast("bigint")).when(
        number.rlike(r"^[+-]?\d{1,18}\.\d+$"), number.try_cast("decimal(38,18)").try_cast("bigint")
    )


def _parts(text: Column, form: str) -> Column:
    """The numbers of a JSON array, put together by ``form``."""
    return F.regexp_replace(text, r"^\[(\d+),(\d+),(\d+)(?:,(\d+),(\d+)(?:,(\d+)(?:,(\d+))?)?)?\]$", form)


def _date(text: Column) -> Column:
    """An ISO date, the date of a date-time, or ``[year, month, day]``."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}(T.*)?$"), F.substring(text, 1, 10).try_cast("date")).when(
        text.rlike(r"^\[\d{4},\d{1,2},\d{1,2}\]$"), _parts(text, "$1-$2-$3").try_cast("date")
    )


def _time(text: Column) -> Column:
    """An ISO local date-time, with or without ``Z``, or an array of its parts
    down to minutes, seconds or nanoseconds. Other zones are a fault."""
    iso = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?Z?$")
    numbers = F.split(F.substring(text, 2, F.length(text) - 2), ",")
    whole = _parts(text, "$1-$2-$3T$4:$5:")
    nanos = F.rpad(F.substring(F.lpad(F.coalesce(F.get(numbers, F.lit(6)), F.lit("0")), 9, "0"), 1, 6), 6, "0")
    listed = F.concat(whole, F.coalesce(F.get(numbers, F.lit(5)), F.lit("0")), F.lit("."), nanos)
    return F.when(iso, F.regexp_replace(text, "Z$", "").try_cast("timestamp_ntz")).when(
        text.rlike(r"^\[\d{4},\d{1,2},\d{1,2},\d{1,2},\d{1,2}(,\d{1,2}(,\d{1,9})?)?\]$"),
        listed.try_cast("timestamp_ntz"),
    )


_READERS = {"userId": _long, "checkinDate": _date, "eventTimestamp": _time}


def _reason(value: Column, strict: bool) -> Column:
    text = F.trim(value)
    unread = F.lit(False)
    if not strict:
        for name in _MANY_FORMS:
            unread |= F.col(f"__{name}").isNotNull() & F.col(name).isNull()
    return (
        F.when(value.isNull() | (text == ""), MALFORMED)
        .when(text == "null", NULL_RECORD)
        .when(F.col(_CORRUPT).isNotNull() | unread, MALFORMED)
        .when(F.col("eventId").isNull(), NULL_EVENT_ID)
        .when(F.col("userId").isNull(), NULL_USER_ID)
        .when(F.col("checkinDate").isNull(), NULL_CHECKIN_DATE)
    )


def _metadata(struct: str) -> Column:
    fields = [F.col(f"{struct}.{wire}").alias(name) for wire, name in METADATA_FIELDS.items()]
    return F.when(F.col(struct).isNotNull(), F.struct(*fields))


def decode_checkins(
    df: DataFrame, value_col: str = "value", on_error: str = "fail", strict: bool = False
) -> DataFrame:
    """Check-in columns parsed from ``value_col``, plus the other columns.

    A user id may be text or have a fraction, which is cut; dates and times may
    be arrays of numbers; a time may end in ``Z``, which is dropped. With
    ``strict`` these are faults. A time with another zone always is.

    ``on_error="fail"``: the first unusable record fails the job; the JSON
    text ``null`` is skipped. ``on_error="quarantine"``: every record stays,
    with its text in ``raw`` and the fault in ``reason`` (null where usable);
    see ``split_quarantine``.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"unknown on_error: {on_error!r}")
    value = F.col(value_col).cast("string")
    rest = [name for name in df.columns if name != value_col]
    parsed = df.select(*rest, value.alias("raw")).select("*", _parse(F.col("raw"), strict))
    if not strict:
        parsed = parsed.withColumnsRenamed({n: f"__{n}" for n in _MANY_FORMS}).withColumns(
            {n: _READERS[n](F.col(f"__{n}")) for n in _MANY_FORMS}
        )
    decoded = parsed.select(
        *rest,
        F.col("eventId").alias("event_id"),
        F.col("userId").alias("user_id"),
        F.col("checkinDate").alias("checkin_date"),
        F.col("eventTimestamp").alias("event_timestamp"),
        F.col("yearMonth").alias("year_month"),
        _metadata("metadata").alias("metadata"),
        "raw",
        _reason(F.col("raw"), strict).alias("reason"),
    )
    if on_error == "quarantine":
        return decoded
    failure = F.raise_error(
        F.concat_ws(" ", F.lit("unusable check-in record:"), F.col("reason"), F.col("raw"))
    )
    usable = (
        F.when(F.col("reason").isNull(), True)
        .when(F.col("reason") == NULL_RECORD, False)
        .otherwise(failure.cast("boolean"))
    )
    return decoded.filter(usable).drop("raw", "reason")


def split_quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable check-ins, and unusable records as ``raw`` and ``reason``."""
    good = decoded.filter(F.col("reason").isNull()).drop("raw", "reason")
    bad = decoded.filter(F.col("reason").isNotNull()).drop(*CHECKIN_FIELDS)
    return good, bad


def iso_time(time: Column) -> Column:
    """ISO local date-time text with only the fraction digits it needs."""
    full = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, r"\.?0+$", "")


def encode_transaction() -> Column:
    """JSON text of a transaction row: wire names in wire order, ISO dates and
    times, missing values written as ``null``."""
    metadata = F.when(
        F.col("metadata").isNotNull(),
        F.struct(*[F.col(f"metadata.{c}").alias(w) for w, c in METADATA_FIELDS.items()]),
    )
    texts = {
        "event_timestamp": iso_time(F.col("event_timestamp")),
        "processed_at": iso_time(F.col("processed_at")),
        "metadata": metadata,
    }
    fields = [texts.get(c, F.col(c)).alias(w) for w, c in TRANSACTION_WIRE_FIELDS.items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def encode_transactions(transactions: DataFrame) -> DataFrame:
    """One JSON text per transaction, in column ``value``."""
    return transactions.select(encode_transaction().alias("value"))


def kafka_records(transactions: DataFrame) -> DataFrame:
    """Key and value of each output message; the key is the user id as text,
    so a user's transactions stay in one partition."""
    return transactions.select(
        F.col("user_id").cast("string").alias("key"),
        encode_transaction().alias("value"),
    )
