"""Exact nearest binary codes by incremental multi-index hashing.

A 64-bit code is cut into segments. Every block of codes has, for each segment,
a table of the codes by segment value. A query first looks up its own segment
values, then all values at one bit's distance, and so on, one segment at a
time; every code found is verified by its full Hamming distance. When the first
j + 1 of m segments have been searched to radius s and the others to s - 1, any
code within m * s + j has been found, because one of its segments must lie
within what was searched. A query ends when its k-th verified distance is that
small, so results are exact; ties go to the smaller id.

Of equal codes only the k + 1 smallest different ids can be in a result, so
only these are searched; that bounds groups of equal codes and changes nothing.
Blocks and query groups have a bounded size, and every group of queries meets
every block: a block is indexed and sent once for each of the few large groups.

Defined results: rows without an id or code take no part, rows that repeat an
id with the same code count once; a query never finds its own id; an id that is
asked with several codes has a ranking for each; with fewer than k other rows,
all are returned.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stampcard.llm.common import query_groups, written

BITS = 64


@dataclass(frozen=True)
class HammingPlan:
    k: int = 10
    block_rows: int = 1_048_576
    #: Most queries of a group, and the fewest that make one more task worth it.
    query_rows: int = 262_144
    least_queries: int = 256


def sign_code(vector: Column) -> Column:
    """Bit i of the code: whether component i is above zero. Components beyond
    the 64th are added by exclusive or; null for a null vector."""
    bit = lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i % BITS)).otherwise(
        F.lit(0).cast("bigint")
    )
    return F.aggregate(F.transform(vector, bit), F.lit(0).cast("bigint"), lambda code, x: code.bitwiseXOR(x))


class _Index:
    """Codes of one block by segment value."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray) -> None:
        self.ids, self.codes = ids, codes
        parts = max(1, round(BITS / max(1.0, math.log2(max(2, len(codes))))))
        edges = [BITS * i // parts for i in range(parts + 1)]
        self.shifts, self.widths = edges[:-1], [b - a for a, b in zip(edges, edges[1:])]
        self.orders, self.starts = [], []
        for shift, width in zip(self.shifts, self.widths):
            value = self._segment(codes, shift, width)
            self.orders.append(np.argsort(value, kind="stable"))
            self.starts.append(np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << width))]))
        self.masks: dict[tuple[int, int], np.ndarray] = {}
        self.seen = np.full(len(codes), -1, dtype=np.int64)

    @staticmethod
    def _segment(codes: np.ndarray, shift: int, width: int) -> np.ndarray:
        return ((codes >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)

    def _flips(self, width: int, radius: int) -> np.ndarray:
        """All values with ``radius`` of ``width`` bits set."""
        if (width, radius) not in self.masks:
            bits = combinations([1 << b for b in range(width)], radius)
            self.masks[width, radius] = np.array([sum(x) for x in bits], dtype=np.int64)
        return self.masks[width, radius]

    def nearest(self, number: int, query_id: int, code: np.uint64, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest; ``number`` tells queries apart."""
        own = [int(self._segment(code, s, w)) for s, w in zip(self.shifts, self.widths)]
        parts = len(own)
        near, ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for radius in range(max(self.widths) + 1):
            for j in range(parts):
                values = own[j] ^ self._flips(self.widths[j], radius)
                first, count = self.starts[j][values], self.starts[j][values + 1] - self.starts[j][values]
                filled = count > 0
                first, count = first[filled], count[filled]
                if len(first):
                    skip = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
                    rows = self.orders[j][skip + np.arange(len(skip))]
                    rows = rows[self.seen[rows] != number]
                    self.seen[rows] = number
                    rows = rows[self.ids[rows] != query_id]
                    near = np.concatenate([near, np.bitwise_count(self.codes[rows] ^ code).astype(np.int64)])
                    ids = np.concatenate([ids, self.ids[rows]])
                    if len(near) > k:
                        best = np.lexsort((ids, near))[:k]
                        near, ids = near[best], ids[best]
                if len(near) == k and near.max() <= parts * radius + j:
                    return ids, near
        return ids, near


def nearest_codes(codes: DataFrame, queries: DataFrame, plan: HammingPlan = HammingPlan()) -> DataFrame:
    """``query_id, rank, id, distance`` of each query's k nearest codes. Both
    tables have ``id`` and ``code`` (bigint)."""
    usable = "id IS NOT NULL AND code IS NOT NULL"
    place = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    rows = written(
        codes.filter(usable).select("id", "code").distinct().withColumn("place", place).filter(F.col("place") <= plan.k + 1).drop("place"),
        "hamming-codes",
    )
    asked = written(queries.filter(usable).select("id", "code").distinct(), "hamming-queries")
    blocks = max(1, math.ceil(rows.count() / plan.block_rows))
    parts = query_groups(codes.sparkSession, asked.count(), blocks, plan.query_rows, plan.least_queries)
    row = F.xxhash64("id", "code")
    index = rows.select(
        F.pmod(row, F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        "id",
        "code",
    )
    search = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(row, F.lit(parts)).cast("int").alias("part"),
        "id",
        "code",
    )

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            block = _Index(left["id"].to_numpy(), left["code"].to_numpy().view(np.uint64))
            asked_codes = right["code"].to_numpy().view(np.uint64)
            for number, (query_id, code) in enumerate(zip(right["id"].to_numpy(), asked_codes)):
                ids, near = block.nearest(number, query_id, code, plan.k)
                out.append((np.full(len(ids), query_id), np.full(len(ids), code).view(np.int64), ids, near))
        columns = [np.concatenate([x[i] for x in out]) if out else np.zeros(0, dtype=np.int64) for i in range(4)]
        return pa.table({"query_id": columns[0], "code": columns[1], "id": columns[2], "distance": columns[3].astype(np.int32)})

    found = (
        index.groupBy("block", "part")
        .cogroup(search.groupBy("block", "part"))
        .applyInArrow(searched, "query_id bigint, code bigint, id bigint, distance int")
    )
    order = Window.partitionBy("query_id", "code").orderBy("distance", "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= plan.k)
    return ranked.select("query_id", "rank", "id", "distance")
