"""Deduplication in keyed state with a time to live.

A (user, event id) is remembered for the time to live counted from the moment
its first copy was let through; copies in between do not renew it. A range of
event times cannot express that, so this is one small stateful operator.

State is kept by bucket, a hash of user and event id, and all rows of a bucket
are handled together: a bucket's state is a map from a stretch of time to the
keys marked in it, packed into one value, so the calls between Python and the
JVM are per bucket and stretch and not per event. A batch writes the stretch it
lies in and no other. Keys are told apart by 128 bits of hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

KEYS = ["user_id", "event_id"]
# Not with a leading underscore: the state API would rename such columns.
HASHES = ["dedup_k1", "dedup_k2"]
#: Buckets of state: a few for each task, as each costs some state calls a batch.
BUCKETS = 128
#: Stretches of time into which the time to live is cut.
STRETCHES = 64


class FirstArrivals(StatefulProcessor):
    """Lets through the earliest copy of each key that is not remembered.

    Spark drops a stretch by itself when its last keys have expired; buckets
    with rows drop theirs at once.
    """

    def __init__(self, ttl_ms: int, columns: list[str], clock: str | None) -> None:
        self.ttl = ttl_ms
        self.stretch = max(1, ttl_ms // STRETCHES)
        self.columns = columns
        self.clock = clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "stretch bigint", "marks binary", self.ttl + self.stretch)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            both = frame if first is None else pd.concat([first, frame])
            first = both.sort_values("arrival_seq", kind="stable").drop_duplicates(HASHES)
        if first is None:
            return
        if self.clock is None:
            now = np.full(len(first), timerValues.getCurrentProcessingTimeInMs(), dtype=np.int64)
        else:
            now = first[self.clock].to_numpy(dtype=np.int64)
        marks = []
        stretches = {}
        for (stretch,), (packed,) in list(self.seen.iterator()):
            if (stretch + 1) * self.stretch <= now.min() - self.ttl:
                self.seen.removeKey((stretch,))
            else:
                stretches[stretch] = packed
                marks.append(np.frombuffer(packed, dtype=np.int64).reshape(-1, 3))
        keys = first[HASHES].to_numpy(dtype=np.int64)
        fresh = now - self.ttl >= _last_marks(keys, marks)
        new, now = first[fresh], now[fresh]
        for stretch in np.unique(now // self.stretch).tolist():
            here = now // self.stretch == stretch
            rows_of = np.column_stack([keys[fresh][here], now[here]])
            self.seen.updateValue((stretch,), (bytes(stretches.get(stretch, b"")) + rows_of.tobytes(),))
        if len(new):
            yield new[self.columns]

    def close(self) -> None:
        pass


def _last_marks(keys: np.ndarray, marks: list[np.ndarray]) -> np.ndarray:
    """When each key (two hashes) was marked last; long ago if it was not."""
    found = np.full(len(keys), np.iinfo(np.int64).min)
    known = np.concatenate(marks) if marks else np.zeros((0, 3), dtype=np.int64)
    if len(known):
        known = known[np.lexsort((known[:, 2], known[:, 1], known[:, 0]))]
        # Of the rows of one first hash, few if not one, the second decides.
        low, high = (np.searchsorted(known[:, 0], keys[:, 0], side) for side in ("left", "right"))
        for step in range(int((high - low).max())):
            at = np.minimum(low + step, len(known) - 1)
            same = (low + step < high) & (known[at, 1] == keys[:, 1])
            found[same] = known[at[same], 2]
    return found


def _first_of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    ordered = batch.take(pc.sort_indices(batch.column("arrival_seq")))
    keys = pa.table(
        [*[ordered.column(name) for name in KEYS], pa.array(range(ordered.num_rows), pa.int64())],
        names=[*KEYS, "row"],
    )
    firsts = keys.group_by(KEYS).aggregate([("row", "min")])
    return ordered.take(firsts.column("row_min").combine_chunks())


def keep_first_copies(df: DataFrame) -> DataFrame:
    """Thin out copies within each Arrow batch, before the shuffle."""

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _first_of_batch(batch)

    return df.mapInArrow(thin, df.schema)


def dedup_stream(
    df: DataFrame, ttl_ms: int, marks_col: str | None = None, clock_col: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """First arrivals of a stream with ``user_id``, ``event_id`` and
    ``arrival_seq``.

    Every row let through is remembered. Where some rows must not be, such as
    those over quota, give them a false ``marks_col``: they are dropped. Time is
    the processing time, or the milliseconds in ``clock_col``.

    A user with a third of all events is spread over all buckets; copies of one
    event are thinned out before they are shuffled. A stream keeps the number of
    buckets it was first started with.
    """
    if marks_col is not None:
        df = df.filter(marks_col).drop(marks_col)
    hashes = [F.xxhash64(*KEYS).alias("dedup_k1"), F.xxhash64(F.lit("second"), *KEYS).alias("dedup_k2")]
    return (
        keep_first_copies(df)
        .select("*", *hashes)
        .withColumn("dedup_bucket", F.pmod("dedup_k1", F.lit(buckets)))
        .groupBy("dedup_bucket")
        .transformWithStateInPandas(
            statefulProcessor=FirstArrivals(ttl_ms, df.columns, clock_col),
            outputStructType=df.schema,
            outputMode="Append",
            timeMode="ProcessingTime",
        )
    )
