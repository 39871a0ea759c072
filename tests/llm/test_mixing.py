"""Mixing: targets, nearness, and odd rows."""

from collections import defaultdict

from stampcard.llm.mixing import MixPlan, mix_sources, source_targets

SCHEMA = "doc_id bigint, text string, source string, size int, target string"


def by_hand(sizes, weights, share, most):
    """Targets by dealing the excess again until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in full]
        total = sum(weight[s] for s in free)
        left = budget - sum(full.values())
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            return full | {s: left * weight[s] / total for s in free}
        full |= {s: float(most * sizes[s]) for s in over}


def test_targets_equal_repeated_dealing(spark):
    sizes = {"b": 100, "a": 5, "é": 40, "z": 1000, None: 7, "c": 0, "aa": 300}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in source_targets(rows, MixPlan()).collect()}
    want = by_hand(sizes, (3, 1, 2), 1.5, 2)
    assert set(got) == set(want)
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_taken_words_come_near_targets(spark):
    rows = [(i, "w " * (i * 7 % 60), f"s{i % 3 and i % 5}", 1, "x") for i in range(3000)]
    got = mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()
    taken, target, most = defaultdict(int), {}, defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        most[r.source] = max(most[r.source], r.size)
    assert len(got) == 3000
    assert all(abs(taken[s] - target[s]) <= most[s] for s in target)


def test_odd_rows_and_reruns(spark):
    rows = [
        (None, None, None, None, None), (1, "", "a", 1, "t"), (2, " \t\r\n", "a", 1, "t"), (3, "x", None, 1, "t"),
        (4, "one two", "a", 1, "t"), (4, "one two", "a", 1, "t"), (5, "w " * 100_000, "b", 1, "t"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    first = sorted(map(tuple, mix_sources(df).collect()), key=str)
    assert first == sorted(map(tuple, mix_sources(df.repartition(5)).collect()), key=str)
    assert len(first) == len(rows)
    assert {r[2] for r in first if r[0] == 5} == {100_000}


def test_no_rows(spark):
    assert mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []
