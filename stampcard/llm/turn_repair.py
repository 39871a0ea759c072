"""Conversations put back into turns by the cheapest edits.

A repaired conversation's role initials read ``(s?(ua)+)?``. Rows are kept,
given another role or deleted, and empty turns inserted; four states (nothing
yet, after the system turn, after a user, after an assistant) say what may come
next. Hirschberg's division finds the cheapest edits in linear space: the
costs of reaching each state by the middle of a conversation and the costs of
ending from there meet, one state is chosen for the crossing, and both halves
are solved alike. Among the cheapest the least text of edit initials wins. The
forward pass ranks the states by their least texts. Texts of two states at one
crossing are never the start of one another, as both end in a row's edit after
equally many rows, so the rank alone decides.

Rows are put in order once by a range partitioning on conversation and turn,
which also splits a conversation of any size. Each piece of a split conversation
gives a 4 by 4 table of costs and ranks; these few tables decide the states
in which its pieces begin and end, and then every piece is solved by itself.
Only the last step, which hashes a conversation's repaired text, takes it in
one task, as a stream and without holding it.

Defined results: a null role or text is one space; rows of one turn are in order
of role, then of a hash of the text, so equal ones are adjacent; rows without a
turn come first; rows without a conversation are one conversation. A role counts
by its first letter, an empty one as none. Texts may be of any length; a table
without rows gives none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stampcard.llm.common import written

#: Rows a task takes at a time, about.
SEGMENT_ROWS = 20_000

FAULTS = ("blank", "duplicate", "truncated")
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
INF = 1 << 60
#: Where a user's or an assistant's turn leads from each state, and its name.
TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAME = {USER: "user", ASSISTANT: "assistant"}
#: What an edit costs.
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
#: What the turns missing at the end cost, and how many they are.
TAIL_TURNS = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
TAIL = [INSERT * TAIL_TURNS[s] for s in STATES]

# Kinds of rows: by the role's initial (s, u, a, other) and whether truncated,
# and one for rows that must go.
GONE = 8
INITIALS = {"s": 0, "u": 1, "a": 2}
KEEPS = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}


def _steps(kind: int) -> dict[tuple[int, int], tuple[int, str]]:
    """(state before, after): cost and initials of the cheapest edits of a row
    with the turns inserted before it. More than two are never of use."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    more = TRUNCATED if kind < GONE and kind % 2 else 0
    for before in STATES:
        state = before
        for turns in range(3):
            options = [(state, DELETE, "D")]
            if kind < GONE:
                options.append((TURN[state], REROLE + more, "R"))
                if (state, kind // 2) in KEEPS:
                    options.append((KEEPS[state, kind // 2], more, "K"))
            for after, cost, letter in options:
                found = (INSERT * turns + cost, "I" * turns + letter)
                best[before, after] = min(found, best.get((before, after), found))
            state = TURN[state]
    return best


STEPS = [_steps(kind) for kind in range(GONE + 1)]
INTO = [[[(p, *s[p, q]) for p in STATES if (p, q) in s] for q in STATES] for s in STEPS]
FROM = [[[(q, s[p, q][0]) for q in STATES if (p, q) in s] for p in STATES] for s in STEPS]


def _ranks(keys: dict[int, tuple]) -> list[int]:
    ranks = [0] * 4
    for i, state in enumerate(sorted(keys, key=keys.__getitem__)):
        ranks[state] = i
    return ranks


def forward(kinds: bytes, entry: int) -> tuple[list[int], list[int]]:
    """Cost of being in each state after the rows, and the order of the states'
    least texts."""
    cost, rank = [INF] * 4, [0] * 4
    cost[entry] = 0
    for kind in kinds:
        new, keys = [INF] * 4, {}
        for q, ways in enumerate(INTO[kind]):
            way = min(((cost[p] + c, rank[p], s) for p, c, s in ways if cost[p] < INF), default=None)
            if way is not None:
                new[q], keys[q] = way[0], way[1:]
        cost, rank = new, _ranks(keys)
    return cost, rank


def backward(kinds: bytes, exit_: int | None) -> list[int]:
    """Cost from each state before the rows to ``exit_``, or to any good end."""
    cost = list(TAIL) if exit_ is None else [0 if s == exit_ else INF for s in STATES]
    for kind in reversed(kinds):
        cost = [min((c + cost[q] for q, c in ways), default=INF) for ways in FROM[kind]]
    return cost


def edits_of(kinds: bytes, entry: int, exit_: int | None) -> list[tuple[int, str]]:
    """(state after, edit initials) of each row, by divide and conquer."""
    out: list[tuple[int, str]] = [(START, "")] * len(kinds)
    open_ = [(0, len(kinds), entry, exit_)]
    while open_:
        low, high, p, e = open_.pop()
        if high - low == 1:
            step = STEPS[kinds[low]]
            ends = STATES if e is None else [e]
            _, text, q = min(
                (step[p, q][0] + (TAIL[q] if e is None else 0), step[p, q][1], q) for q in ends if (p, q) in step
            )
            out[low] = (q, text)
            continue
        middle = (low + high) // 2
        ahead, rank = forward(kinds[low:middle], p)
        back = backward(kinds[middle:high], e)
        _, _, crossing = min((ahead[s] + back[s], rank[s], s) for s in STATES)
        open_ += [(low, middle, p, crossing), (middle, high, crossing, e)]
    return out


def crossings(pieces: list[list[tuple[list[int], list[int]]]]) -> list[int | None]:
    """States in which the pieces of a conversation end (None: the last one
    chooses), from their tables: for each entry the costs and ranks."""
    cost, rank = [0, INF, INF, INF], [0] * 4
    came: list[list[int]] = []
    for piece in pieces:
        new, keys, source = [INF] * 4, {}, [0] * 4
        for q in STATES:
            way = min(((cost[p] + piece[p][0][q], rank[p], p) for p in STATES if cost[p] < INF), default=None)
            if way is not None and way[0] < INF:
                new[q], source[q] = way[0], way[2]
                keys[q] = (way[1], piece[way[2]][1][q])
        cost, rank = new, _ranks(keys)
        came.append(source)
    _, _, state = min((cost[s] + TAIL[s], rank[s], s) for s in STATES)
    ends: list[int | None] = [None]
    for source in reversed(came[1:]):
        state = source[state]
        ends.append(state)
    return ends[::-1]


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with the faults a hash of conversation and
    turn picks: dropped, emptied, without ends of sentences, repeated, or said
    by the user."""
    number = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    pick = F.pmod(F.crc32(number.cast("binary")), F.lit(20))
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    picked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), pick.alias("__pick")).filter("__pick > 0")
    return picked.select(
        "conv_id",
        "turn",
        F.when(F.col("__pick") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("__pick") == 1, F.lit(""))
        .when(F.col("__pick") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("__pick") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"),
    ).drop("__copy")


def in_order(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The rows as a written table with ``__id``, which rises with conversation
    and turn; its upper bits number the pieces."""
    spark = rows.sparkSession
    named = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    keyed = named.withColumn("__hash", F.xxhash64("text")).withColumn("__row", F.monotonically_increasing_id())
    keys = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("__hash"), F.asc("__row")]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(width, math.ceil(rows.count() / segment_rows))
    sorted_rows = keyed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return written(sorted_rows.drop("__hash", "__row").withColumn("__id", F.monotonically_increasing_id()), "turns")


def with_faults(turns: DataFrame) -> DataFrame:
    """Narrow rows: ``__id, __segment, conv_id, initial, fault`` (the first
    fault's name, or null), as a written table."""
    text = F.col("text")
    blank = ~text.rlike(r"[^\x20\x09-\x0D]")
    narrow = turns.select(
        "__id",
        "conv_id",
        F.substring("role", 1, 1).alias("initial"),
        blank.alias("__blank"),
        (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("__cut"),
        "role",
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("__digest"),
    )
    first = narrow.filter("NOT __blank").groupBy("conv_id", "role", "__digest").agg(F.min("__id").alias("__id"))
    marked = narrow.drop("role", "__digest").join(first.select("__id", F.lit(True).alias("__first")), "__id", "left")
    fault = (
        F.when(F.col("__blank"), F.lit("blank"))
        .when(F.col("__first").isNull(), F.lit("duplicate"))
        .when(F.col("__cut"), F.lit("truncated"))
    )
    return written(
        marked.select("__id", F.shiftright("__id", 33).alias("__segment"), "conv_id", "initial", fault.alias("fault")), "turn-faults"
    )


def _runs(ids: list) -> Iterator[tuple[int, int]]:
    """Ranges of equal neighbours."""
    begin = 0
    for i in range(1, len(ids) + 1):
        if i == len(ids) or ids[i] != ids[begin]:
            yield begin, i
            begin = i


def _kinds(initials: list[str], faults: list[str | None]) -> bytes:
    return bytes(
        GONE if f in ("blank", "duplicate") else 2 * INITIALS.get(i, 3) + (f == "truncated") for i, f in zip(initials, faults)
    )


def _piece_tables(rows: DataFrame) -> DataFrame:
    """One row per piece of a conversation: how many of its rows, its outer
    initials and, where it may go on in a neighbour, its costs and ranks."""
    schema = StructType(
        [rows.schema["conv_id"], *StructType.fromDDL("__segment bigint, first string, last string, costs array<bigint>, ranks array<int>").fields]
    )

    def tables(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("__id")
        ids = rows.column("conv_id").to_pylist()
        initials, faults = rows.column("initial").to_pylist(), rows.column("fault").to_pylist()
        segment = rows.column("__segment")[0].as_py()
        runs = list(_runs(ids))
        found = []
        for n, (low, high) in enumerate(runs):
            costs = ranks = None
            if n in (0, len(runs) - 1):
                kinds = _kinds(initials[low:high], faults[low:high])
                passes = [forward(kinds, p) for p in STATES]
                costs, ranks = [c for cost, _ in passes for c in cost], [r for _, rank in passes for r in rank]
            found.append((ids[low], segment, initials[low], initials[high - 1], costs, ranks))
        types = [rows.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.table([pa.array(list(c), t) for c, t in zip(zip(*found), types)], names=schema.names)

    return rows.groupBy("__segment").applyInArrow(tables, schema)


def _paths(pieces: DataFrame) -> DataFrame:
    """For each piece the state before it, the state after it (null: any good
    end), and the initial before it. A conversation has as many pieces as it
    has tasks' worth of rows, so what is held here is small."""
    schema = StructType([pieces.schema["conv_id"], *StructType.fromDDL("__segment bigint, entry int, leave int, before string").fields])

    def solved(group: list[dict]) -> Iterator[tuple]:
        ends: list[int | None] = [None]
        if len(group) > 1:
            ends = crossings(
                [[(g["costs"][4 * p : 4 * p + 4], g["ranks"][4 * p : 4 * p + 4]) for p in STATES] for g in group]
            )
        entry, before = START, None
        for g, end in zip(group, ends):
            yield g["conv_id"], g["__segment"], entry, end, before
            entry, before = end, g["last"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema.names
        group: list[dict] = []
        for batch in batches:
            out: list[tuple] = []
            types = [batch.schema.field("conv_id").type, pa.int64(), pa.int32(), pa.int32(), pa.string()]
            for row in batch.to_pylist():
                if group and group[0]["conv_id"] != row["conv_id"]:
                    out += solved(group)
                    group = []
                group.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)
        if group:
            out = list(solved(group))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "__segment").mapInArrow(found, schema)


def _lines(states: list[int]) -> str:
    return "".join(f"{NAME[s]}:\n" for s in states)


def edits(rows: DataFrame) -> DataFrame:
    """Each row's edit: ``edit`` (initials, with the inserts before it and, for
    the last row, behind it), ``lead`` and ``trail`` (the inserted lines), ``named``
    (its new role), and ``fault``, ``illegal``, ``cost``."""
    paths = _paths(_piece_tables(rows))
    schema = StructType(
        [
            rows.schema["conv_id"],
            *StructType.fromDDL(
                "__id bigint, edit string, lead string, trail string, named string, fault string, illegal int, cost int"
            ).fields,
        ]
    )

    def solved(rows: pa.Table, paths: pa.Table) -> pa.Table:
        rows = rows.sort_by("__id")
        kind_of_id = rows.schema.field("conv_id").type
        ids, initials, faults = (rows.column(c).to_pylist() for c in ("conv_id", "initial", "fault"))
        ways = {p["conv_id"]: p for p in paths.to_pylist()}
        edit, lead, trail, named, illegal, cost = [], [], [], [], [], []
        for low, high in _runs(ids):
            way = ways[ids[low]]
            kinds = _kinds(initials[low:high], faults[low:high])
            state, before = way["entry"], way["before"]
            chosen = edits_of(kinds, state, way["leave"])
            for i, (after, text) in enumerate(chosen, low):
                illegal.append(int(before is not None and before + initials[i] not in ("su", "ua", "au")))
                before = initials[i]
                inserted = []
                for _ in text[:-1]:
                    state = TURN[state]
                    inserted.append(state)
                more = TRUNCATED if kinds[i - low] < GONE and kinds[i - low] % 2 else 0
                here = {"K": more, "R": REROLE + more, "D": DELETE}[text[-1]] + INSERT * len(inserted)
                state = after
                ending = []
                if i == high - 1 and way["leave"] is None:
                    last = state
                    for _ in range(TAIL_TURNS[state]):
                        last = TURN[last]
                        ending.append(last)
                edit.append(text + "I" * len(ending))
                lead.append(_lines(inserted))
                trail.append(_lines(ending))
                named.append(NAME[after] if text[-1] == "R" else None)
                cost.append(here + INSERT * len(ending))
        columns = [
            rows.column("conv_id").cast(kind_of_id), rows.column("__id"), pa.array(edit, pa.string()), pa.array(lead, pa.string()),
            pa.array(trail, pa.string()), pa.array(named, pa.string()), pa.array(faults, pa.string()),
            pa.array(illegal, pa.int32()), pa.array(cost, pa.int32()),
        ]
        return pa.table(columns, names=schema.names)

    return rows.groupBy("__segment").cogroup(paths.groupBy("__segment")).applyInArrow(solved, schema)


def repaired_lines(turns: DataFrame, edited: DataFrame) -> DataFrame:
    """``conv_id, __id, edit, lines``: a row's part of the repaired text, each
    line with its newline. The result is dealt by conversation."""
    line = F.concat(F.coalesce("named", "role"), F.lit(":"), F.col("text"), F.lit("\n"))
    gone = F.rtrim(F.col("edit"), F.lit("I")).endswith("D")
    changes = edited.select("__id", "edit", "lead", "trail", "named")
    return turns.join(changes, "__id").select(
        "conv_id", "__id", "edit", F.concat("lead", F.when(gone, F.lit("")).otherwise(line), "trail").alias("lines")
    )


def digests(lines: DataFrame) -> DataFrame:
    """``conv_id, audit, repaired_sha256``; a conversation's text streams by."""
    schema = StructType([lines.schema["conv_id"], *StructType.fromDDL("audit string, repaired_sha256 string").fields])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, letters, state, begun, kind = None, [], None, False, None
        done: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), (kind, pa.string(), pa.string()))]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            texts = batch.column("lines").cast(pa.binary())
            for i, (conv, edit) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("edit").to_pylist())):
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, "".join(letters), state.hexdigest()))
                    now, letters, state, begun = conv, [], hashlib.sha256(), False
                letters.append(edit)
                if text := texts[i].as_py():
                    state.update((b"\n" if begun else b"") + text[:-1])
                    begun = True
            if done:
                yield batch_of(done)
                done = []
        if state is not None:
            yield batch_of([(now, "".join(letters), state.hexdigest())])

    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "__id")
    return ordered.select("conv_id", "edit", "lines").mapInArrow(hashed, schema)


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> tuple[DataFrame, DataFrame]:
    """The rows in order (``in_order``) and their edits, both written tables."""
    turns = in_order(rows, segment_rows)
    return turns, written(edits(with_faults(turns)), "turn-edits")


def _gaps(turn: Column) -> Column:
    return F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("bigint")


def repair_report(rows: DataFrame, conversations: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row per conversation of ``conversations`` (``conv_id``): faults of
    its rows in ``rows``, the cheapest repair, and its digest."""
    turns, edited = repair(rows, segment_rows)
    counts = [F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in FAULTS]
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("illegal", "cost")]
    facts = edited.groupBy("conv_id").agg(*counts, *sums)
    gaps = turns.groupBy("conv_id").agg(_gaps(F.col("turn")).alias("gaps"))
    found = digests(repaired_lines(turns, edited))
    out = conversations.select("conv_id").distinct()
    for part in (gaps, facts, found):
        renamed = part.withColumnRenamed("conv_id", "__conv")
        out = out.join(renamed, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").drop("__conv")
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", *FAULTS, "illegal", "cost")]
    nothing = F.lit(hashlib.sha256().hexdigest())
    return out.select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )
