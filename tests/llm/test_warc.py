"""Archives: round trips with version lines inside payloads, at any split."""

import hashlib
import random

import pytest

from stampcard.llm import warc
from stampcard.session import scratch_path

SCHEMA = "id bigint, uri string, payload binary"


def expected(rows):
    first = {}
    for i, _, payload in rows:
        if i is not None:
            key = payload or b""
            first[key] = min(first.get(key, i), i)
    out = []
    for i, uri, payload in rows:
        payload = payload or b""
        to = first.get(payload) if len(payload) >= 100 else None
        to = None if to == i or sum((p or b"") == payload for _, _, p in rows) == 1 else to
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if to is not None else "response", to))
    return sorted(out, key=str)


def result(df):
    return sorted(
        ((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str
    )


def hostile_rows(n):
    rng = random.Random(5)
    magic, rows = b"WARC/1.0\r\n", []
    fake = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    for i in range(n):
        body = bytes(rng.choice(b"ab\r\nW") for _ in range(rng.randrange(0, 300)))
        if i % 3 == 0:
            body += magic + b"x" * rng.randrange(50)
        if i % 4 == 0:
            body += fake % (rng.randrange(80), b"y" * rng.randrange(80)) * 3
        if i % 5 == 0:
            body = magic * rng.randrange(1, 40)
        rows.append((i, f"http://h/{i}", bytes(body)))
    rows += [(200 + i, None, rows[0][2] * 2) for i in range(4)]
    rows += [(300, "u", None), (301, "u\r\nWARC/1.0\r\n", b""), (None, "n", b"q" * 150), (None, "n", b"\xff\xfe" * 80)]
    rows += [(400, "same", b"z" * 200)] * 3
    return rows


@pytest.mark.parametrize("split, n", [("64", 12), ("1500", 120), ("128m", 120)])
def test_round_trip_at_any_split(spark, split, n):
    rows = hostile_rows(n)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = result(warc.round_trip(spark.createDataFrame(rows, SCHEMA).coalesce(2)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == expected(rows)


def test_files_are_plain_records(spark):
    path = scratch_path(spark, "warc-plain")
    warc.write_warc(spark.createDataFrame([(7, "http://x/", b"h\xc3\xa9")], SCHEMA), path)
    (text,) = [r.content for r in spark.read.format("binaryFile").load(path).collect() if r.length]
    assert bytes(text).startswith(b"WARC/1.0\r\nWARC-Type: response\r\n")
    assert bytes(text).endswith(b"Content-Length: 3\r\n\r\nh\xc3\xa9\r\n\r\n")


def test_no_rows(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cut_off_archive_is_an_error(spark, tmp_path):
    record = "WARC/1.0\r\nContent-Length: 10\r\n\r\nshort"
    (tmp_path / "a.warc").write_text(record, newline="")
    with pytest.raises(ValueError):
        warc.read_warc(spark, str(tmp_path)).count()


def test_cores_that_come_and_go_between_the_scans(spark, monkeypatch):
    """The number of cores decides the splits; it changes after the first scan."""
    rows, entries = hostile_rows(120), warc._entries
    path = scratch_path(spark, "warc-cores")
    warc.write_warc(spark.createDataFrame(rows, SCHEMA).coalesce(2), path)

    def changed(exits):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "31")
        return entries(exits)

    monkeypatch.setattr(warc, "_entries", changed)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = result(warc.read_warc(spark, path))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert got == expected(rows)
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_payload_that_is_not_the_claimed_one_is_an_error(spark, tmp_path):
    digest = hashlib.sha256(b"other").hexdigest()
    record = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha256:{digest}\r\nContent-Length: 5\r\n\r\nshort\r\n\r\n"
    (tmp_path / "a.warc").write_text(record, newline="")
    with pytest.raises(ValueError, match="digest"):
        warc.read_warc(spark, str(tmp_path)).count()


def test_many_hostile_rows_at_the_smallest_split(spark):
    """Paths over very many blocks, and a repeated payload that spans dozens."""
    rows = hostile_rows(120)
    rows += [(500 + i, None, rows[0][2] * 9) for i in range(4)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = result(warc.round_trip(spark.createDataFrame(rows, SCHEMA).coalesce(2)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == expected(rows)
