"""Collision-counting search against brute force."""

import math

import numpy as np

from stampcard.llm.collision_ann import CollisionPlan, nearest_neighbours
from stampcard.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, query_id bigint"


def brute(rows, query_ids, k):
    """Nearest by cosine in double precision, ties to the smaller id."""
    good = [(i, np.array(v, dtype=float)) for i, v in rows]
    out = {}
    for q in query_ids:
        x = next(v for i, v in good if i == q)
        scored = sorted(
            (-float(x @ v) / math.sqrt(float(x @ x)) / math.sqrt(float(v @ v)), i) for i, v in good if i != q
        )
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_recall_over_the_whole_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 50 == 0], 5)
    got = QUERIES["op6_collision_ann"](spark, sf_dir).collect()
    hits = 0
    for r in got:
        scores = dict(want[r.query_id])
        hits += r.vec_id in scores
        assert r.vec_id not in scores or abs(scores[r.vec_id] - r.score) < 1e-9
    assert len(got) == 5 * len(want)
    assert hits >= 0.9 * len(got)


def test_small_blocks_give_the_same(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    queries = vectors.filter("vec_id % 50 = 0")
    want = brute([(r.vec_id, r.embedding) for r in vectors.collect()], [r.vec_id for r in queries.collect()], 5)
    got = nearest_neighbours(vectors, queries, CollisionPlan(block_rows=70, query_rows=3)).collect()
    assert sum(r.vec_id in dict(want[r.query_id]) for r in got) >= 0.9 * 5 * len(want)


def by_rows(rows, queries, k):
    """Results of every query row: all other rows with as many components."""
    out = []
    for n, (q, x) in enumerate(rows):
        if n in queries:
            scored = []
            for m, (i, v) in enumerate(rows):
                if m != n and len(v) == len(x):
                    a, b = (np.ldexp(np.array(y), -np.frexp(np.abs(y).max())[1]) for y in (x, v))
                    scored.append((-round(float(a @ b) / math.sqrt(float(a @ a)) / math.sqrt(float(b @ b)), 9), i))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def test_repeated_ids_and_rows_mixed_lengths_and_tiny_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(2).tolist()) for i in range(9)]
    rows += [(i, rng.standard_normal(3).tolist()) for i in (0, 0, 20, 21, 22)]  # another length, a repeated id
    rows += [rows[0], rows[0], (0, [0.5, 0.25]), (1, [2.0, 1.0])]  # equal rows, an id with another vector
    rows += [(30, [1e-200, 0.0]), (31, [5e-324, 0.0]), (32, [1e300, 1e299])]
    queries = [n for n, (i, _) in enumerate(rows) if i in (0, 30, 31, 32, 20)]
    df = spark.createDataFrame([(i, v, 1, 9) for i, v in rows], "vec_id bigint, embedding array<double>, label int, score bigint")
    got = nearest_neighbours(df, df.filter("vec_id in (0, 30, 31, 32, 20)"), CollisionPlan(width=4.0)).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9) + 0.0) for r in got) == by_rows(rows, queries, 5)


def test_unusable_vectors_ties_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1, 9), (1, [2.0, 0.0], 1, 9), (2, [3.0, 0.0], None, 9), (3, [0.0, 1.0], 1, None),
        (4, None, 1, 9), (5, [0.0, 0.0], 1, 9), (6, [nan, 1.0], 1, 9), (7, [inf, 1.0], 1, 9),
        (8, [None, 1.0], 1, 9), (9, [1.0, 1.0, 1.0], 1, 9), (None, [1.0, 0.0], 1, 9), (10, [], 1, 9),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = nearest_neighbours(df, df.filter("vec_id in (0, 5)")).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got] == [
        (0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.0),
    ]


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert nearest_neighbours(df, df).count() == 0
