"""WARC archives: writing with duplicate payloads as revisits, and reading back
by boundary-chain verification.

Writing. Each row becomes a record; Spark's text writer lays the records of a
task into one file, with the record end as its line separator, so a file is a
plain sequence of WARC/1.0 records. Files are written through Spark, so any
store and the output commit protocol work as for other tables.

Reading. Archives are split anywhere: Spark's text reader cuts them at the
version line, which may also occur inside payloads. Every piece is a candidate
record; sizes summed over the pieces give its offset in the file, its own
length header gives the offset of its successor. Only candidates that can be
reached from the file's start through successors are records. Within a split,
a candidate's path is followed to where it leaves the split; over the splits of
a file, pointer jumping doubles the path in each round. A payload is the joined
text of the candidates that its record covers.

Defined results: a null payload is an empty one; a null id is written as no id
and read back as null; of equal payloads the row with the smallest id (nulls
last) is the response, and rows equal to it (id and payload) are written like
it; a record cut off at a file's end, or a response whose payload is not
the one its SHA-256 names, raises an error when read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stampcard.llm.common import salted_lookup, written
from stampcard.session import scratch_path

VERSION_LINE = "WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
#: Equal payloads of at least so many bytes are stored once.
MIN_SHARED_BYTES = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def plan_records(rows: DataFrame) -> DataFrame:
    """``id, uri, payload`` (binary) with ``digest``, ``bytes``, ``refers_to``
    and ``record_type`` of each row."""
    payload = F.coalesce("payload", F.lit("").cast("binary"))
    digested = rows.select(
        "id",
        "uri",
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("bigint").alias("bytes"),
    )
    shared = (
        digested.filter(F.col("bytes") >= MIN_SHARED_BYTES)
        .groupBy(F.unhex("digest").alias("key"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("response_id"))
        .filter("n > 1")
        .select("key", "response_id")
    )
    found = salted_lookup(
        digested.withColumn("key", F.unhex("digest")), written(shared, "warc-shared"), ["key"], ["id", "uri"]
    )
    revisit = F.col("response_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("response_id"))
    return found.select(
        "id",
        "uri",
        "payload",
        "digest",
        "bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response_id")).alias("refers_to"),
    )


def _record_id(value: Column) -> Column:
    return F.concat(F.lit("<urn:x-record:"), F.coalesce(value.cast("string"), F.lit("")), F.lit(">"))


def write_warc(rows: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``id, uri, payload`` rows as archives in the folder ``path``."""
    records = plan_records(rows)
    revisit = F.col("record_type") == "revisit"
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    uri = F.regexp_replace(F.coalesce("uri", F.lit("")), "[\r\n]+", " ")
    header = F.concat(
        F.lit(VERSION_LINE),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(
            revisit,
            F.concat(line("WARC-Refers-To", _record_id(F.col("refers_to"))), line("WARC-Profile", F.lit(REVISIT_PROFILE))),
        ).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
        F.lit("\r\n"),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    records.select(F.concat(header, body).alias("value")).write.option("lineSep", RECORD_END).option(
        "compression", "none"
    ).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archives of a folder, cut at version lines. ``row`` numbers the
    pieces of a block in order; it is the same in every scan of the folder, if
    the scans are split alike (see ``_same_splits``)."""
    return (
        spark.read.option("lineSep", VERSION_LINE)
        .text(path)
        .select(
            F.xxhash64("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
            F.col("value").alias("body"),
        )
    )


@contextmanager
def _same_splits(spark: SparkSession) -> Iterator[None]:
    """Scans inside split a folder alike. Unless told, Spark takes the size of a
    split from the number of cores, which changes as executors come and go."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before:
            spark.conf.set(name, before)
        else:
            spark.conf.unset(name)


def candidates(pieces: DataFrame) -> DataFrame:
    """One row per piece, without its text: ``offset`` of its version line
    (below 0 for what precedes a file's first one), the ``successor`` it claims
    (null without a proper header), and what its header says."""
    body = F.col("body")
    ended = F.instr(body, RECORD_END) > 0
    head = F.when(ended, F.substring_index(body, RECORD_END, 1))
    field = lambda name: F.regexp_extract(F.col("head"), rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    length = F.when(field("Content-Length").rlike(r"^\d{1,17}\s*$"), F.trim(field("Content-Length")).cast("bigint"))
    header_bytes = F.octet_length("head") + len(RECORD_END)
    whole = F.col("size") >= F.col("header_bytes") + F.col("length")
    return (
        pieces.withColumn("head", head)
        .withColumn("size", F.octet_length(body).cast("bigint"))
        .withColumn("length", length)
        .withColumn("header_bytes", header_bytes.cast("bigint"))
        .select(
            "file",
            "file_size",
            "block",
            "row",
            "size",
            "length",
            "header_bytes",
            field("WARC-Type").alias("record_type"),
            _id_of(field("WARC-Record-ID")).alias("id"),
            _id_of(field("WARC-Refers-To")).alias("refers_to"),
            field("WARC-Target-URI").alias("uri"),
            F.regexp_replace(field("WARC-Payload-Digest"), "^sha256:", "").alias("claimed"),
            F.when(
                whole,
                F.sha2(F.substring(body.cast("binary"), F.col("header_bytes").cast("int") + 1, F.col("length").cast("int")), 256),
            ).alias("digest"),
        )
    )


def _id_of(value: Column) -> Column:
    return F.regexp_extract(value, r"^<urn:x-record:(-?\d+)>", 1).try_cast("bigint")


def _with_offsets(found: DataFrame) -> DataFrame:
    """Offsets from sizes: sums over the pieces of a block, and over the blocks
    of a file."""
    mark = len(VERSION_LINE)
    taken = F.col("size") + mark
    blocks = found.groupBy("file", "block").agg(F.sum(taken).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("base") + F.coalesce(F.sum(taken).over(inside), F.lit(0)) - mark
    return (
        found.join(written(bases, "warc-bases"), ["file", "block"])
        .withColumn("offset", offset)
        .withColumn(
            "successor", F.col("offset") + mark + F.col("header_bytes") + F.col("length") + len(RECORD_END)
        )
    )


def _jumps(offset: np.ndarray, successor: np.ndarray) -> np.ndarray:
    """Index of each candidate's successor in the sorted ``offset``, or -1."""
    at = np.minimum(np.searchsorted(offset, successor), len(offset) - 1)
    return np.where((offset[at] == successor) & (successor > offset), at, -1)


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    offset = table["offset"].to_numpy()
    order = np.argsort(offset)
    successor = pc.fill_null(table["successor"], -1).to_numpy()
    return order, offset[order], successor[order]


def _leave_block(table: pa.Table) -> pa.Table:
    """Where the path of each candidate leaves its block."""
    order, offset, successor = _arrays(table)
    jump, out = _jumps(offset, successor), successor.copy()
    while (jump >= 0).any():
        go = jump >= 0
        out[go] = out[jump[go]]
        jump[go] = jump[jump[go]]
    return pa.table({"file": table["file"], "offset": offset, "out": out})


def _follow(table: pa.Table) -> pa.Table:
    """The candidates of a block that its reached entries lead to, and for all
    candidates the record that covers them (null before the first record)."""
    order, offset, successor = _arrays(table)
    reached = pc.fill_null(table["entry"], False).to_numpy(zero_copy_only=False)[order].copy()
    jump = _jumps(offset, successor)
    while (jump >= 0).any():
        from_ = reached & (jump >= 0)
        reached[jump[from_]] = True
        go = jump >= 0
        jump[go] = jump[jump[go]]
    last = np.maximum.accumulate(np.where(reached, np.arange(len(offset)), -1))
    cover = pa.array(offset[np.maximum(last, 0)], mask=last < 0)
    return pa.table(
        {
            "file": table["file"],
            "block": table["block"],
            "row": table["row"].take(pa.array(order)),
            "offset": offset,
            "reached": reached,
            "cover": cover,
        }
    )


def _entries(exits: DataFrame) -> DataFrame:
    """Offsets at which the true path of a file enters a block, by pointer
    jumping from offset 0 over the blocks."""
    jumps = written(
        exits.filter("out > offset").select("file", F.col("offset").alias("at"), F.col("out").alias("to")), "warc-jumps"
    )
    reached = written(exits.select("file").distinct().select("file", F.lit(0).cast("bigint").alias("at")), "warc-reached")
    size = reached.count()
    while True:
        reached = written(
            reached.unionByName(reached.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))).distinct(),
            "warc-reached",
        )
        grown = reached.count()
        if grown == size:
            return reached
        size = grown
        further = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("far"))
        jumps = written(
            jumps.join(further, ["file", "to"]).select("file", "at", F.col("far").alias("to")), "warc-jumps"
        )


def _whole_records(spark: SparkSession, path: str) -> DataFrame:
    """The records with what their headers say and the ``digest`` of their own
    payload. The folder is scanned twice: for candidates, and for the bodies of
    the records that reach over several pieces."""
    pieces = _pieces(spark, path)
    found = written(_with_offsets(written(candidates(pieces), "warc-candidates")), "warc-offsets")
    chain = found.filter("offset >= 0").select("file", "block", "row", "offset", "successor")
    exits = written(
        chain.groupBy("file", "block").applyInArrow(_leave_block, "file bigint, offset bigint, out bigint"), "warc-exits"
    )
    entries = written(_entries(exits), "warc-entries")
    ends = found.select("file", F.col("file_size").alias("at")).distinct()
    broken = ends.join(entries, ["file", "at"], "left_anti").head(1)
    if broken:
        raise ValueError(f"an archive in {path} does not end with a whole record")
    flagged = chain.join(
        entries.select("file", F.col("at").alias("offset"), F.lit(True).alias("entry")), ["file", "offset"], "left"
    )
    kinds = "file bigint, block bigint, row bigint, offset bigint, reached boolean, cover bigint"
    walked = written(flagged.groupBy("file", "block").applyInArrow(_follow, kinds), "warc-walked")

    records = found.join(walked.filter("reached").select("file", "row"), ["file", "row"], "left_semi")
    # Records that reach into further pieces: their payload holds version lines.
    lasts = walked.groupBy("file", "block").agg(F.max("cover").alias("last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select("file", "block", F.max("last").over(earlier).alias("carried"))
    covers = walked.join(written(carried, "warc-carried"), ["file", "block"]).select(
        "file", "row", "offset", F.coalesce("cover", "carried").alias("record")
    )
    torn = records.filter(F.col("digest").isNull()).select(
        "file", F.col("offset").alias("record"), "header_bytes", "length"
    )
    parts = written(covers.join(torn, ["file", "record"]), "warc-parts")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "body"))), lambda x: x["body"]), VERSION_LINE)
    payload = F.substring(F.col("text").cast("binary"), F.col("header_bytes").cast("int") + 1, F.col("length").cast("int"))
    joined = (
        parts.join(pieces.select("file", "row", "body"), ["file", "row"])
        .groupBy("file", "record", "header_bytes", "length")
        .agg(text.alias("text"))
        .select("file", F.col("record").alias("offset"), F.sha2(payload, 256).alias("joined"))
    )
    return written(
        records.join(joined, ["file", "offset"], "left").select(
            "id", "uri", "record_type", "refers_to", "claimed", "length", F.coalesce("digest", "joined").alias("digest")
        ),
        "warc-records",
    )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives in ``path``: ``id, uri, record_type,
    refers_to, payload_bytes, payload_digest`` (both of the full payload, for a
    revisit that of its response)."""
    with _same_splits(spark):
        whole = _whole_records(spark, path)
    revisit = F.col("record_type") == "revisit"
    hashed = F.col("claimed").rlike("^[0-9a-fA-F]{64}$")
    if whole.filter(~revisit & hashed & ~F.lower("claimed").eqNullSafe(F.col("digest"))).head(1):
        raise ValueError(f"an archive in {path} has a response whose payload is not the one its digest names")
    targets = whole.filter(revisit).select(F.col("refers_to").alias("r"), F.col("claimed").alias("c")).distinct()
    responses = (
        whole.filter(~revisit)
        .join(targets, (F.col("id") == F.col("r")) & (F.col("digest") == F.col("c")), "left_semi")
        .groupBy(F.col("id").alias("refers_to"), F.col("digest").alias("claimed"))
        .agg(F.max("length").alias("full"))
    )
    resolved = salted_lookup(
        whole.filter(revisit), written(responses, "warc-responses"), ["refers_to", "claimed"], ["id", "uri"]
    )
    columns = ["id", "uri", "record_type", "refers_to"]
    return (
        whole.filter(~revisit)
        .select(*columns, F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"))
        .unionByName(
            resolved.select(*columns, F.col("full").alias("payload_bytes"), F.col("claimed").alias("payload_digest"))
        )
    )


def round_trip(rows: DataFrame) -> DataFrame:
    """Write ``id, uri, payload`` rows as archives in the shared folder, and
    read them back."""
    spark = rows.sparkSession
    path = scratch_path(spark, "warc-archives")
    write_warc(rows, path)
    return read_warc(spark, path)
