"""Near duplicates against all-pairs Jaccard, with hot groups, and odd rows."""

import random
import re

import pytest

from stampcard.llm.minhash_join import JoinPlan, near_duplicates
from stampcard.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, label string, c bigint, node bigint"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(number of shingles, component) by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            x, y = sets[i], sets[j]
            if x and y and min(len(x), len(y)) * 4 >= 3 * max(len(x), len(y)) and find(i) != find(j):
                if 100 * len(x & y) >= 75 * len(x | y):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def compare(spark, rows, plan):
    df = spark.createDataFrame([(i, t, "l", 1, 2) for i, t in rows], SCHEMA)
    got = near_duplicates(df, plan).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def groups_of_copies(rng):
    """Copies with more and more edits, chains, and texts that share a passage."""
    words = [f"w{i}" for i in range(3000)]
    passage = rng.choices(words, k=60)
    rows = []
    for size in (2, 3, 30, 120):
        base = rng.choices(words, k=rng.randrange(60, 160))
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(0, 6)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append(" ".join(text))
        rows += [" ".join(base)] * 3
    chain = rng.choices(words, k=90)
    for _ in range(12):
        chain = chain[4:] + rng.choices(words, k=4)
        rows.append(" ".join(chain))
    for _ in range(80):
        rows.append(" ".join(passage + rng.choices(words, k=rng.randrange(5, 40))))
    rows += [" ".join(rng.choices(words, k=rng.randrange(1, 9))) for _ in range(60)]
    rng.shuffle(rows)
    return list(enumerate(rows, 10))


@pytest.mark.parametrize("leaf, levels", [(512, 4), (8, 3)])
def test_equal_to_all_pairs(spark, leaf, levels):
    compare(spark, groups_of_copies(random.Random(leaf)), JoinPlan(leaf=leaf, levels=levels))


@pytest.mark.parametrize("pay", [0.0, 2.0])
def test_deeper_levels_with_pivots_and_without(spark, pay):
    compare(spark, groups_of_copies(random.Random(5)), JoinPlan(leaf=8, levels=4, pivots_pay=pay))


def test_odd_rows(spark):
    rows = [
        (5, "a b c d e f"), (3, "A  B\tC D\nE f"), (7, "a b"), (8, "A b"), (9, ""), (10, None), (11, " \n "),
        (None, "x y z u v w"), (12, "x y z u v w"), (None, "lonely text of a row without id"), (5, "a b c d e f"), (13, "é É"), (14, "é é"),
        (15, "k " * 60_000), (16, "k " * 60_000 + "end"),
    ]
    df = spark.createDataFrame([(i, t, "l", 1, 2) for i, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted(
        [
            (5, 2, 3, False), (5, 2, 3, False), (3, 2, 3, True), (7, 1, 7, True), (8, 1, 7, False), (9, 0, 9, True),
            (10, 0, 10, True), (11, 0, 11, True), (None, 2, 12, False), (12, 2, 12, True), (None, 3, None, True),
            (13, 1, 13, True), (14, 1, 14, True), (15, 1, 15, True), (16, 2, 16, True),
        ],
        key=str,
    )


def test_an_id_with_several_texts_links_their_classes(spark):
    a, b, c, d = ("a b c d e f", "g h i j k l", "m n o p q r", "s t u v w x")
    rows = [(3, a), (5, a), (5, b), (7, b), (8, c), (9, d), (9, d), (None, d), (None, "y z y z y z")]
    df = spark.createDataFrame([(i, t, "l", 1, 2) for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted(
        [(3, 3, True), (5, 3, False), (5, 3, False), (7, 3, False), (8, 8, True), (9, 9, True), (9, 9, True),
         (None, 9, False), (None, None, True)],
        key=str,
    )


def test_no_rows(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_over_the_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op8_minhash_join"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
