"""Turn repair: the cheapest, least edits against all edits, for any pieces."""

import hashlib
import random
from functools import cache
from itertools import product

from stampcard.llm import turn_repair as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost string, __id int"
GOOD = {"", *("ua" * n for n in range(1, 9)), *("s" + "ua" * n for n in range(1, 9))}


@cache
def cheapest(rows):
    """Of all edits of (role, text, fault) rows: cost, initials, repaired text."""
    best = None
    gap = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    names = {"u": "user", "a": "assistant"}
    options = [
        [("D", 3, None)]
        if fault in ("blank", "duplicate")
        else [("D", 3, None)]
        + [("K", fault == "truncated", (role, text))]
        + [("R", 2 + (fault == "truncated"), (names[x], text)) for x in "ua"]
        for role, text, fault in rows
    ]
    for inserted in product(gap, repeat=len(rows) + 1):
        for chosen in product(*options):
            cost, letters, out = 0, "", []
            for i, more in enumerate(inserted):
                cost += 2 * len(more)
                letters += "I" * len(more)
                out += [(names[x], "") for x in more]
                if i < len(rows):
                    letter, price, line = chosen[i]
                    cost, letters = cost + price, letters + letter
                    out += [line] if line else []
            if "".join(r[:1] if r else "?" for r, _ in out) in GOOD:
                found = (cost, letters, "\n".join(f"{r}:{t}" for r, t in out))
                best = min(best or found, found)
    return best


def by_hand(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0))
    seen, faulty = set(), []
    for _, _, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faulty.append((role, text, fault))
    initials = [r[:1] for r, _, _ in faulty]
    turns = [r[1] for r in rows if r[1] is not None]
    cost, audit, text = cheapest(tuple(faulty))
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[sum(f == name for _, _, f in faulty) for name in T.FAULTS],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256(text.encode()).hexdigest(),
    )


def report(spark, rows, segment_rows=T.SEGMENT_ROWS):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = T.repair_report(df, df, segment_rows).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r)[1:] for r in got}


def conversations(rng, count, most):
    out = []
    for c in range(count):
        for t in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "system", "tool"] + ["user", "assistant"] * 2)
            out.append((c, 2 * t, role, rng.choice(["Yes.", "No!", "cut", " ", f"{t}?", f"open {t}"])))
    return out


def test_the_cheapest_and_least_of_all_edits(spark):
    rng = random.Random(5)
    rows = conversations(rng, 120, 3)
    want = {c: by_hand([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert report(spark, rows) == want


def test_conversations_cut_into_pieces_give_the_same(spark):
    rng = random.Random(6)
    rows = conversations(rng, 40, 30) + [(99, t, rng.choice(["user", "user", "assistant"]), f"{t}.") for t in range(600)]
    assert report(spark, rows, 3) == report(spark, rows)


def test_division_equals_one_pass_over_all_states():
    rng = random.Random(7)
    for _ in range(300):
        kinds = bytes(rng.randrange(T.GONE + 1) for _ in range(rng.randint(1, 40)))
        cost, rank = T.forward(kinds, T.START)
        total = min(c + t for c, t in zip(cost, T.TAIL))
        assert T.backward(kinds, None)[T.START] == total
        # One pass that carries whole texts instead of ranks.
        texts = {T.START: (0, "")}
        for kind in kinds:
            step = T.STEPS[kind]
            new = {}
            for (p, q), (c, s) in step.items():
                if p in texts:
                    found = (texts[p][0] + c, texts[p][1] + s)
                    new[q] = min(found, new.get(q, found))
            texts = new
        best = min((c + T.TAIL[q], s + "I" * T.TAIL_TURNS[q]) for q, (c, s) in texts.items())
        chosen = T.edits_of(kinds, T.START, None)
        assert "".join(s for _, s in chosen) + "I" * T.TAIL_TURNS[chosen[-1][0]] == best[1]
        at = rng.randint(0, len(kinds))
        pieces = [p for p in (kinds[:at], kinds[at : at + 1], kinds[at + 1 :]) if p]
        ends = T.crossings([[T.forward(p, e) for e in T.STATES] for p in pieces])
        entry, joined = T.START, []
        for piece, end in zip(pieces, ends):
            joined += T.edits_of(piece, entry, end)
            entry = end
        assert joined == chosen


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, None, "user", "A."), (1, 5, "user", "A."), (1, 5, "user", "A."),
        (None, 0, "user", "x" * 300_000 + " "), (None, 1, "assistant", "y. \n"),
        (2, None, "", "B."), (3, 1, "User", "C."), (4, -3, "system", "S."), (4, 7, "user", "é!\t"),
    ]
    got = report(spark, rows)
    assert got == {c: by_hand([r for r in rows if r[0] == c]) for c in (None, 1, 2, 3, 4)}
    assert got[1][0] == 0 and got[4][0] == 9


def test_a_hot_conversation_of_equal_rows(spark):
    rows = [(7, 1, "user", "Same.")] * 500 + [(c, 0, "user", "Hi.") for c in range(5)]
    got = report(spark, rows, 50)
    assert got[7][:6] == (0, 0, 499, 0, 499, 2 + 3 * 499)
    assert got[7][6] == "K" + "D" * 499 + "I"


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(4)] + [(None, None, None, None)]
    got = sorted(map(str, T.damaged(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()))
    want = []
    for c, t, role, text in rows:
        pick = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if pick == 1 else text.translate({ord(x): None for x in ".!?"}) if pick == 2 else text
        want += [(c, t, "user" if pick == 4 else role, text)] * {0: 0, 3: 2}.get(pick, 1)
    assert got == sorted(f"Row(conv_id={c!r}, turn={t!r}, role={r!r}, text={x!r})" for c, t, r, x in want)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.repair_report(empty, empty).collect() == []
    one = spark.createDataFrame([(1, 1, "user", "x", "", 0)], SCHEMA)
    assert [tuple(r) for r in T.repair_report(empty, one).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
