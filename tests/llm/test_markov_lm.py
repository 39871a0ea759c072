"""Hidden Markov language model: recursions against plain ones, counts against
brute force, and held-out likelihood."""

import math
import re
import zlib
from collections import Counter
from dataclasses import replace
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from stampcard.llm.common import crc_part
from stampcard.llm import markov_lm as M

SCHEMA = "doc_id bigint, text string, row string, score int"
PLAN = M.MarkovPlan(states=3, known_words=40, own_classes=8, other_classes=5, slices=3, prior=5.0)


def small_model(k=3, classes=4, seed=0):
    rng = np.random.default_rng(seed)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    empty = np.zeros(0, dtype=np.int64)
    return M.MarkovModel(
        M.MarkovPlan(states=k), empty, empty, empty, 1, np.ones(classes), 0, 0, 0,
        norm(rng.random((2, k)), 1), norm(rng.random((k, k)), 1), norm(rng.random((classes, k)), 0),
    )


def paths(m, sequence, cut=0):
    """All state paths of a sequence with their probability."""
    for path in product(range(m.plan.states), repeat=len(sequence)):
        p = m.entry[cut, path[0]] * m.emit[sequence[0], path[0]]
        for a, b, c in zip(path, path[1:], sequence[1:]):
            p *= m.move[a, b] * m.emit[c, b]
        yield path, p


def test_likelihoods_and_expected_counts_are_sums_over_all_paths():
    m = small_model()
    sequences = [[0, 1, 2, 3, 1], [2], [3, 3, 0, 1], [1, 0], [2, 2, 2, 1]]
    cut = [0, 1, 1, 0, 0]
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    flat = np.array([c for s in sequences for c in s], dtype=np.int32)
    length = np.array([len(s) for s in sequences])
    start = np.cumsum(length) - length
    out, want = M.Counts.none(4, 3), M.Counts.none(4, 3)
    M.expect(out, m, flat, start[order], length[order], np.array(cut)[order])
    got = M.likelihoods(m, flat, start[order], length[order])
    for n, i in enumerate(order):
        whole = sum(p for _, p in paths(m, sequences[i]))
        assert math.isclose(got[n], math.log10(whole), rel_tol=1e-12)
        total = sum(p for _, p in paths(m, sequences[i], cut[i]))
        for path, p in paths(m, sequences[i], cut[i]):
            want.entry[cut[i], path[0]] += p / total
            for a, b in zip(path, path[1:]):
                want.move[a, b] += p / total
            for s, c in zip(path, sequences[i]):
                want.emit[c, s] += p / total
    assert np.allclose(out.rows(), want.rows(), rtol=1e-10)


def test_rounds_never_lower_the_likelihood(spark):
    m = replace(small_model(3, 6, 2), plan=M.MarkovPlan(states=3, prior=0.0, piece=4))
    rng = np.random.default_rng(1)
    texts = [[int(c) for c in rng.integers(0, 3, 9) + 3 * (i % 2)] for i in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "classes array<int>").repartition(5)
    before = -math.inf
    for _ in range(6):
        counts = M.expected_counts(df, m)
        assert math.isclose(counts.emit.sum(), 9 * 60) and math.isclose(counts.entry.sum(), 3 * 60)
        now = 0.0
        for t in texts:
            pieces = [t[:4], t[4:8], t[8:]]
            now += sum(math.log(sum(p for _, p in paths(m, s, int(i > 0)))) for i, s in enumerate(pieces))
        assert now >= before - 1e-6
        before = now
        emit = np.maximum(counts.emit, 1e-12)
        m = replace(
            m, emit=emit / emit.sum(axis=0), move=counts.move / counts.move.sum(axis=1, keepdims=True),
            entry=counts.entry / counts.entry.sum(axis=1, keepdims=True),
        )


def words(text):
    text = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def by_hand(rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter()
    for i, text, *_ in rows:
        if not held(i):
            counts.update(words(text) + [None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text, *_ in rows:
        tokens = words(text) + [None]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        out.append((i, held(i), len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6)))
    return sorted(out, key=str)


def score(spark, rows, plan=PLAN):
    df = spark.createDataFrame(rows, SCHEMA)
    got = M.score_texts(df, crc_part(F.col("doc_id"), 10) == 0, plan).collect()
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    return sorted([(*tuple(r)[:5], round(r.base_score, 6)) for r in got], key=str), got


@pytest.mark.parametrize("known", [1, 40, 100_000])
def test_counts_and_base_score_by_hand(spark, known):
    rng = np.random.default_rng(4)
    vocabulary = [f"W{int(i)}é" for i in range(60)]
    rows = [
        (i, "\t".join(rng.choice(vocabulary, rng.integers(0, 40), p=None)) + " Rare" * (i % 50 == 0) + f"\n{i // 3}x", "", 0)
        for i in range(200)
    ]
    got, _ = score(spark, rows, replace(PLAN, known_words=known))
    assert got == by_hand(rows)


def test_odd_rows(spark):
    rows = [(1, None, "", 0), (2, "", "", 0), (None, "a B a", "", 0), (4, "a b", "", 0), (4, "a b", "", 0), (6, "x" * 200_000, "", 0)]
    rows += [(7, "new words held Out", "", 0), (8, "a " * 30_000, "", 0)]
    got, full = score(spark, rows)
    assert got == by_hand(rows)
    assert len({r.score for r in full if r.doc_id == 4}) == 1


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    got, _ = score(spark, [(held, "a b", "", 0)])
    assert got == [(held, True, 3, 0, 0, 0.0)]
    assert score(spark, [])[0] == []


def test_probabilities_of_all_one_word_texts_sum_to_less_than_one(spark):
    """Seen words and one unseen word in each class share what one state path has."""
    rows = [(i, f"w{i % 7} w{i % 5}", "", 0) for i in range(60)]
    probes = [(1000 + 10 * i, w, "", 0) for i, w in enumerate(["w0", "w1", "w2", "w3", "w4", "w5", "w6", "unseen"])]
    _, full = score(spark, rows + probes)
    assert sum(10**r.score for r in full if r.doc_id >= 1000) < 1


def test_held_out_texts_are_likelier_than_under_the_base(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = M.score_texts(docs, crc_part(F.col("doc_id"), 10) == 0)
    row = scored.filter("held_out").agg(
        (F.sum("score") / F.sum("n_tokens")).alias("own"), (F.sum("base_score") / F.sum("n_tokens")).alias("base")
    ).head()
    assert row.own > row.base + 0.15
