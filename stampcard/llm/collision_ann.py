"""Approximate nearest neighbours by counting collisions over single projections.

Vectors are scaled to length one, where the nearest by distance are the nearest
by cosine. Every block of vectors keeps, for each random direction, the vectors'
projections as a sorted array. A query opens a window around its own projection
in each array; a vector collides in every array whose window holds it. Vectors
with enough collisions are verified by their exact cosine. While the k-th
verified vector lies farther than the search radius, the radius grows and the
windows widen around the query (virtual rehashing): a window is the radius times
a fixed width, so only its new ends are counted.

The collision threshold is the count that a vector at the search radius reaches
in all but ``miss`` of cases; nearer vectors reach it more often.

All rows are indexed. Blocks and query groups have a bounded size, and every
group of queries meets every block, so no task holds a part that grows with the
data; groups are as large as a task may hold, but enough to occupy the cluster,
as a block is sent once for each. Each block returns its k nearest of a query,
and these are merged.

Vectors are scaled by a power of two before they are squared, so neither tiny
nor huge components are lost.

Defined results: vectors that are null, zero, or with null or non-finite
components take no part, nor do rows without an id; vectors of different numbers
of components are never compared; ties go to the smaller id. Every row is a
candidate and, among the queries, a query of its own, whether or not it repeats
an id or a vector; a query does not find its own row, but may find others of
its id.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stampcard.llm.common import written


@dataclass(frozen=True)
class CollisionPlan:
    k: int = 5
    projections: int = 48
    #: Half a window, as a part of the search radius.
    width: float = 1.0
    #: Chance that a vector at the search radius stays below the threshold.
    miss: float = 0.03
    first_radius: float = 0.12
    growth: float = 1.2
    block_rows: int = 65_536
    #: Most queries of a group, and the fewest that make one more task worth it.
    query_rows: int = 65_536
    least_queries: int = 64
    #: Queries of a group whose window bounds are held at a time.
    batch: int = 256
    seed: int = 17

    @property
    def threshold(self) -> int:
        hit = math.erf(self.width / math.sqrt(2))
        m = self.projections
        chance, least = 0.0, 0
        for l in range(m + 1):  # the most collisions reached by all but ``miss``
            chance += math.comb(m, l) * hit**l * (1 - hit) ** (m - l)
            if chance > self.miss:
                least = l
                break
        return max(1, least)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, v`` of the rows that take part, as doubles."""
    v = F.col(vector_column).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(id_column).cast("bigint").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    )


def _counted(rows: DataFrame, name: str) -> DataFrame:
    """Each row once, with the number of equal ones and of components."""
    counted = rows.groupBy("id", "v").agg(F.count(F.lit(1)).cast("int").alias("times"))
    return written(counted.withColumn("n", F.size("v")), name)


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors with a largest component between 1/2 and 1, and the powers of two
    they were divided by."""
    _, power = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -power[:, None]), power


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], column.type)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class _Block:
    """The sorted projections of one block's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, plan: CollisionPlan) -> None:
        vectors, self.power = scaled(vectors)
        self.ids, self.vectors, self.plan = ids, vectors, plan
        self.lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        self.directions = np.random.default_rng(plan.seed).standard_normal((vectors.shape[1], plan.projections))
        points = (vectors / self.lengths[:, None]) @ self.directions
        self.order = np.ascontiguousarray(np.argsort(points, axis=0, kind="stable").T)
        self.sorted = np.ascontiguousarray(np.take_along_axis(points, self.order.T, axis=0).T)
        # On the unit sphere no two points lie farther apart than 2, and no
        # projections farther than twice a direction's length.
        longest = 2 * float(np.sqrt((self.directions**2).sum(axis=0).max()))
        steps = math.ceil(math.log(max(1.0, longest / (plan.first_radius * plan.width)), plan.growth)) + 1
        self.radii = plan.first_radius * plan.growth ** np.arange(steps)

    def windows(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and window bounds by query, radius and projection."""
        lengths = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        centres = (queries / lengths[:, None]) @ self.directions
        half = self.radii * self.plan.width
        shape = (len(queries), len(self.radii), self.plan.projections)
        low, high = np.empty(shape, dtype=np.int32), np.empty(shape, dtype=np.int32)
        start = np.empty((len(queries), self.plan.projections), dtype=np.int32)
        for i, line in enumerate(self.sorted):
            c = centres[:, i]
            start[:, i] = np.searchsorted(line, c)
            low[:, :, i] = np.searchsorted(line, c[:, None] - half)
            high[:, :, i] = np.searchsorted(line, c[:, None] + half, "right")
        return start, low, high

    def nearest(
        self, query_id: int, query: np.ndarray, power: int, start: np.ndarray, low: np.ndarray, high: np.ndarray
    ):
        """Ids and cosines of the nearest found. Bounds are of this query, which
        is scaled."""
        plan, n = self.plan, len(self.ids)
        length = math.sqrt(float(query @ query))
        counts = np.zeros(n, dtype=np.int64)
        verified = np.zeros(n, dtype=bool)
        same = np.flatnonzero((self.ids == query_id) & (self.power == power))
        # Of equal rows one is the query's own, whichever.
        verified[same[(self.vectors[same] == query).all(axis=1)][:1]] = True
        cosine, found = np.zeros(0), np.zeros(0, dtype=np.int64)
        threshold = plan.threshold
        l0, h0 = start.tolist(), start.tolist()
        for radius, l1, h1 in zip(self.radii.tolist(), low.tolist(), high.tolist()):
            ends = [o[x:y] for o, x, y in zip(self.order, l1, l0) if x < y]
            ends += [o[x:y] for o, x, y in zip(self.order, h0, h1) if x < y]
            l0, h0 = l1, h1
            if not ends:
                continue
            touched = np.concatenate(ends)
            if len(touched) < n:
                np.add.at(counts, touched, 1)
                touched = touched[counts[touched] >= threshold]
                fresh = np.unique(touched[~verified[touched]])
            else:
                counts += np.bincount(touched, minlength=n)
                fresh = np.flatnonzero((counts >= threshold) & ~verified)
            if len(fresh):
                verified[fresh] = True
                dots = self.vectors[fresh] @ query
                cosine = np.concatenate([cosine, dots / (self.lengths[fresh] * length)])
                found = np.concatenate([found, fresh])
                if len(found) > plan.k:  # only the k nearest can be among the results
                    best = np.lexsort((self.ids[found], -cosine))[: plan.k]
                    cosine, found = cosine[best], found[best]
            if len(found) >= plan.k and 2 - 2 * cosine.min() <= radius * radius:
                break
        best = np.lexsort((self.ids[found], -cosine))
        return self.ids[found[best]], cosine[best]


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    plan: CollisionPlan = CollisionPlan(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score`` (cosine) of each query's k nearest
    vectors found. ``queries`` are rows of ``vectors``, or others with its
    columns."""
    rows = _counted(usable(vectors, id_column, vector_column), "ann-vectors")
    asked = _counted(usable(queries, id_column, vector_column), "ann-queries")
    # Blocks by number of components; a number that no query has has none.
    counts = rows.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).join(
        asked.groupBy("n").agg(F.count(F.lit(1)).alias("asked")), "n"
    )
    blocks = F.ceil(F.col("rows") / plan.block_rows).cast("int")
    fill = F.ceil(F.lit(vectors.sparkSession.sparkContext.defaultParallelism) / blocks)
    parts = F.greatest(
        F.ceil(F.col("asked") / plan.query_rows), F.least(fill, F.ceil(F.col("asked") / plan.least_queries))
    ).cast("int")
    sizes = written(counts.select("n", blocks.alias("blocks"), parts.alias("parts")), "ann-sizes")
    row = F.xxhash64("id", "v")
    index = rows.join(sizes, "n").select(
        "n",
        F.pmod(row, F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        *("id", "v", "times"),
    )
    search = asked.join(sizes, "n").select(
        "n",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(row, F.col("parts")).cast("int").alias("part"),
        *("id", "v", "times"),
        row.alias("asked"),
    )

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            # Of equal rows no more can be among the nearest, beside one's own.
            times = np.minimum(left["times"].to_numpy(), plan.k + 1)
            block = _Block(np.repeat(left["id"].to_numpy(), times), np.repeat(_matrix(left["v"]), times, axis=0), plan)
            asked_ids, (asked_vectors, powers) = right["id"].to_numpy(), scaled(_matrix(right["v"]))
            facts = [right[c].to_numpy() for c in ("asked", "times")]
            for at in range(0, len(asked_ids), plan.batch):
                part = slice(at, at + plan.batch)
                bounds = block.windows(asked_vectors[part])
                for i, *window in zip(range(at, len(asked_ids)), *bounds):
                    ids, cosine = block.nearest(asked_ids[i], asked_vectors[i], powers[i], *window)
                    own = [np.full(len(ids), x[i]) for x in (asked_ids, *facts)]
                    out.append((*own, ids, cosine))
        kinds = {"query_id": "i8", "asked": "i8", "times": "i4", "vec_id": "i8", "score": "f8"}
        columns = [np.concatenate([x[j] for x in out]) if out else np.zeros(0) for j in range(len(kinds))]
        return pa.table({name: c.astype(kind) for (name, kind), c in zip(kinds.items(), columns)})

    found = (
        index.groupBy("n", "block", "part")
        .cogroup(search.groupBy("n", "block", "part"))
        .applyInArrow(searched, "query_id bigint, asked bigint, times int, vec_id bigint, score double")
    )
    order = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= plan.k)
    # Equal query rows have equal results.
    each = ranked.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return each.select("query_id", "rank", "vec_id", "score")
