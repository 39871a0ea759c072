"""Filter audit: counts by hand, for every order, and odd rows."""

import random
from itertools import permutations

from stampcard.llm.filter_audit import COUNTS, audit, mask_counts

DOCS = "doc_id bigint, text string, lang string, mask int, n string"
LABELS = "doc_id bigint, quality int, toxic int, id string"


def by_hand(docs, labels):
    good = {i for i, q, _, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, _ in labels if t == 1 and i is not None}
    rows = []
    for i, text, lang, *_ in docs:
        text = text or ""
        words = text.replace("\t", " ").replace("\n", " ").split(" ")
        words = [w for w in words if w]
        copy = i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in docs)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": copy,
        }
        rows.append((lang or "", {f for f, x in fails.items() if x}, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                failing = sum(f in r[1] for r in mine)
                alone = sum(r[1] == {f} for r in mine)
                out[part, order, step] = [len(left), len(gone), failing - len(gone), alone, sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def run(spark, docs, labels):
    got = audit(mask_counts(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))).collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in got}
    assert len(out) == len(got)
    return out


def test_every_order_by_hand(spark):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(300):
        words = [rng.choice("abcdefgh") * rng.randint(1, 3) if rng.random() < 0.5 else f"w{rng.randrange(5000)}" for _ in range(rng.choice([5, 199, 200, 260]))]
        text = " ".join(words) + ("#" if rng.random() < 0.2 else "") + "É" * 20 + "X" * rng.choice([0, 0, 60])
        text = docs[-1][1] if docs and rng.random() < 0.2 else text
        docs.append((i // 2 * 3 % 100, text, rng.choice(["en", "de", None, ""]), 0, "x"))
        labels.append((i, rng.choice([0, 1, None]), rng.choice([0, 1]), "x"))
    assert run(spark, docs, labels) == by_hand(docs, labels)


def test_odd_rows(spark):
    docs = [(None, "same", "en", 0, ""), (None, "same", "en", 0, ""), (3, "same", "en", 0, ""), (3, "same", "de", 0, "")]
    docs += [(5, "same", "en", 0, ""), (6, None, None, 0, ""), (7, "", "", 0, ""), (8, "B# " * 100_000, "xx", 0, "")] * 2
    labels = [(5, 1, None, ""), (5, 0, 1, ""), (None, 1, 1, ""), (8, None, None, "")]
    assert run(spark, docs, labels) == by_hand(docs, labels)


def test_no_rows(spark):
    assert run(spark, [], []) == {}


def test_a_third_of_all_rows_one_text(spark):
    docs = [(i, "hot text", "en", 0, "") for i in range(1000)] + [(1000 + i, f"text {i}", "en", 0, "") for i in range(2000)]
    got = run(spark, docs, [(i, 1, 0, "") for i in range(0, 3000, 7)])
    assert got["en", "EABCD", 1][:2] == (2001, 999) and got["en", "EABCD", 2][:2] == (0, 2001)
    assert sum(got["en", "EABCD", k][4] for k in range(1, 6)) == len(range(0, 3000, 7))
