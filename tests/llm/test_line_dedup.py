"""Line dedup: exact spread decisions for any sketch, and odd rows."""

import random
from collections import defaultdict

from stampcard.llm.line_dedup import dedup_lines

SCHEMA = "doc_id bigint, text string, source string, pos int, h string"


def by_hand(rows, min_sites):
    sites, first = defaultdict(set), {}
    for i, text, site in sorted({(r[0], r[1], r[2]) for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0])):
        for p, line in enumerate(text.split("\n")):
            sites[line].add(site)
            first.setdefault(line, (i, text, p))
    keep = lambda i, t, p, line: (
        not line.strip(" ") or len(sites[line]) < min_sites or first[line] == (i, t, p)
    )
    return [
        None if r[1] is None else "\n".join(x for p, x in enumerate(r[1].split("\n")) if keep(r[0], r[1], p, x)) for r in rows
    ]


def test_equal_to_exact_counts_around_the_threshold(spark):
    rng = random.Random(3)
    pool = [f"line {i}" for i in range(60)] + ["", "  "]
    rows = []
    for i in range(400):
        # A line's number bounds the sites on which it occurs.
        site = rng.randrange(14)
        lines = [x for x in rng.choices(pool, k=6) if not x.startswith("l") or int(x[5:]) % 14 >= site]
        rows.append((i, "\n".join(lines), f"s{site}" if site else None, 0, "x"))
    for min_sites in (2, 5, 8, 11):
        got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, SCHEMA), min_sites).collect()}
        assert [got[r[0]] for r in rows] == by_hand(rows, min_sites)


def test_odd_rows(spark):
    rows = [(1, None, "a", 0, "x"), (2, "", "b", 0, "x"), (None, "same\nx", None, 0, "x"), (3, "same\nsame", "c", 0, "x")]
    rows += [(4, "same\n" + "y" * 300_000 + "\nsame", "d", 0, "x")] * 2
    got = dedup_lines(spark.createDataFrame(rows, SCHEMA), 3).collect()
    assert sorted(((r.doc_id, len(r.text or ""), r["__lines"], r["__removed"]) for r in got), key=str) == sorted(
        [(1, 0, 0, 0), (2, 0, 1, 0), (None, 1, 2, 1), (3, 4, 2, 1), (4, 300_000, 3, 2), (4, 300_000, 3, 2)], key=str
    )
    assert got[0].asDict().keys() >= {"pos", "h"}


def test_no_rows(spark):
    assert dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []
