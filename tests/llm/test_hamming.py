"""Exact nearest codes against brute force: repeated rows, nulls, ties, blocks."""

import random

from stampcard.llm.hamming_topk import HammingPlan, nearest_codes, sign_code

SCHEMA = "id bigint, code bigint, rank int, distance string"


def brute(rows, queries, k):
    codes = {(i, c) for i, c in rows if i is not None and c is not None}
    out = []
    for q, x in {(i, c) for i, c in queries if i is not None and c is not None}:
        near = sorted(((x ^ c) & (1 << 64) - 1).bit_count() * (1 << 32) + i for i, c in codes if i != q)[:k]
        out += [(q, r, v & (1 << 32) - 1, v >> 32) for r, v in enumerate(near, 1)]
    return sorted(out)


def run(spark, rows, queries, plan):
    frames = [spark.createDataFrame([(i, c, 0, "x") for i, c in part], SCHEMA) for part in (rows, queries)]
    return sorted(tuple(r) for r in nearest_codes(*frames, plan).collect())


def codes(rng, n):
    base = [rng.getrandbits(64) for _ in range(n // 20)]
    out = []
    for i in range(n):
        code = rng.choice(base) if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.choice([0, 0, 1, 3, 9])):
            code ^= 1 << rng.randrange(64)
        out.append((i, code - (1 << 64) if code >> 63 else code))
    return out


def test_equal_to_brute_force_for_any_blocks(spark):
    rows = codes(random.Random(1), 500)
    for plan in (HammingPlan(), HammingPlan(k=3, block_rows=60, query_rows=7)):
        assert run(spark, rows, rows[::20], plan) == brute(rows, rows[::20], plan.k)


def test_repeated_rows_and_ids_do_not_hide_others(spark):
    rows = [(20, 7)] * 30 + [(40, 7), (5, 7), (6, 6), (6, 8), (7, 4)] + [(50 + i, 7) for i in range(20)]
    queries = [(20, 7), (20, 7), (20, 1), (40, 7)]
    plan = HammingPlan(k=4)
    assert run(spark, rows, queries, plan) == brute(rows, queries, 4)
    assert (20, 3, 50, 0) in run(spark, rows, queries, plan)


def test_nulls_few_rows_and_no_rows(spark):
    rows = [(1, 3), (None, 3), (2, None), (4, -1)]
    assert run(spark, rows, [(1, 3), (None, 1), (9, None)], HammingPlan()) == [(1, 1, 4, 62)]
    assert run(spark, [], [], HammingPlan()) == run(spark, [], [(1, 1)], HammingPlan()) == []
    df = spark.createDataFrame([(None,), ([],), ([0.5, -1.0, 2.0],), ([1.0] * 65,)], "v array<float>")
    assert [r[0] for r in df.select(sign_code("v")).collect()] == [None, 0, 5, -2]
