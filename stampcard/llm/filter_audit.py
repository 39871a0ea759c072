"""What each quality filter removes, in every order the filters can be applied.

Documents are first counted by part and by the set of filters they fail, the
mask; that is all the corpus is needed for. A matrix has 0 where a mask fails a
filter and infinity elsewhere, another one the place of each filter in each
order (the inverse permutations). Their min-plus product is the step at which
an order removes the documents of a mask. Counts are then scattered to those
steps, and what a filter removes less than it fails is redundant.

A text is a copy if a document with a smaller id has the same text (by its
SHA-256). Texts are never gathered: the first id of each text is a partial
aggregate, and the first documents are found by a join on text and id.

Defined results: a null text counts as empty, a null part as the empty string; a
document without an id, and each row of the smallest id of a text, is no copy;
rows that repeat an id count each; of several labels of an id, one that applies
is enough; without documents there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stampcard.llm.common import WORD_PATTERN, written

#: Parts turned into rows at a time.
PARTS_AT_ONCE = 64
FIELDS = "part string, filter_order string, step int"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def all_orders(letters: str) -> list[str]:
    return ["".join(p) for p in permutations(letters)]


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions that one text decides, by letter."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD_PATTERN})"))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def mask_of(failures: dict[str, Column], letters: str) -> Column:
    """The failed filters as bits, the first letter lowest."""
    bits = [F.when(c, F.lit(1 << letters.index(x))).otherwise(F.lit(0)) for x, c in failures.items()]
    return sum(bits[1:], bits[0])


def mask_counts(docs: DataFrame, labels: DataFrame, letters: str = "ABCDE", copies: str = "E") -> DataFrame:
    """Documents by ``part`` and ``mask``: ``n``, and how many of them are good
    and toxic. ``docs`` has doc_id, lang, text; ``labels`` doc_id, quality, toxic."""
    text = F.coalesce("text", F.lit(""))
    marked = docs.select(
        F.col("doc_id").alias("id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        mask_of(text_failures(text), letters).alias("mask"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    facts = (
        labels.groupBy(F.col("doc_id").alias("id"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
        .filter("id IS NOT NULL AND (good OR toxic)")
    )
    flags = [F.coalesce(c, F.lit(False)).cast("int").alias(c) for c in ("good", "toxic")]
    # Rows that say the same are counted before they meet in a join.
    counted = marked.groupBy("id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    rows = written(counted.join(facts, "id", "left").select("id", "part", "mask", "digest", "n", *flags), "audit-rows")
    first = rows.groupBy("digest").agg(F.min("id").alias("id"))
    originals = rows.join(first, ["digest", "id"], "left_semi").unionByName(rows.filter("id IS NULL"))
    bit = 1 << letters.index(copies)
    signed = [
        rows.select("part", (F.col("mask") + bit).alias("mask"), "n", "good", "toxic"),
        originals.select("part", (F.col("mask") + bit).alias("mask"), (-F.col("n")).alias("n"), "good", "toxic"),
        originals.select("part", "mask", "n", "good", "toxic"),
    ]
    return (
        signed[0].unionByName(signed[1]).unionByName(signed[2])
        .groupBy("part", "mask")
        .agg(*[F.sum(c).alias(a) for a, c in (("n", F.col("n")), ("good", F.col("n") * F.col("good")), ("toxic", F.col("n") * F.col("toxic")))])
    )


def removal_steps(masks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Min-plus product of ``masks`` (mask by filter: fails or not) and
    ``places`` (filter by order: its step): the step that removes each mask in
    each order, one more than there are filters where none does."""
    never = len(places) + 1
    cost = np.where(masks, 0, never)
    return np.minimum((cost[:, :, None] + places[None, :, :]).min(axis=1), never)


def part_counts(mask: np.ndarray, weight: np.ndarray, orders: np.ndarray) -> list[np.ndarray]:
    """The counts of one part, each (orders, steps). ``weight`` has a column of
    documents, good ones and toxic ones; ``orders`` the filters by their number."""
    count, size = orders.shape
    fails = (mask[:, None] >> np.arange(size)) & 1 == 1
    steps = removal_steps(fails, np.argsort(orders, axis=1).T + 1)
    cell = np.arange(count)[None, :] * (size + 2) + steps
    removed, good, toxic = (
        np.bincount(cell.ravel(), np.repeat(w, count), count * (size + 2)).astype(np.int64).reshape(count, -1)[:, 1 : size + 1]
        for w in weight.T
    )
    n = weight[:, 0]
    failing = (fails * n[:, None]).sum(axis=0)
    alone = (fails * (n * (fails.sum(axis=1) == 1))[:, None]).sum(axis=0)
    shapley = np.bincount(orders.ravel(), removed.ravel(), size).astype(np.int64)
    kept = n.sum() - np.cumsum(removed, axis=1)
    return [kept, removed, failing[orders] - removed, alone[orders], good, toxic, shapley[orders]]


def audit(counts: DataFrame, letters: str = "ABCDE", orders: Sequence[str] | None = None) -> DataFrame:
    """One row per part, order and step, from the counts by part and mask."""
    names = list(orders or all_orders(letters))
    numbers = np.array([[letters.index(x) for x in order] for order in names])
    schema = f"{FIELDS}, {', '.join(f'{c} bigint' for c in COUNTS)}"
    # At most one entry for each mask: a bounded list.
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(names))
        order = np.repeat(np.array(names, dtype=object), len(letters))
        for batch in batches:
            for low in range(0, batch.num_rows, PARTS_AT_ONCE):
                piece = batch.slice(low, PARTS_AT_ONCE)
                found = []
                for masks in piece.column("masks").to_pylist():
                    table = np.array([[m["mask"], m["n"], m["good"], m["toxic"]] for m in masks], dtype=np.int64)
                    found.append([c.ravel() for c in part_counts(table[:, 0], table[:, 1:], numbers)])
                n = piece.num_rows
                part = np.repeat(np.array(piece.column("part").to_pylist(), dtype=object), len(steps))
                columns = [pa.array(part, pa.string()), pa.array(np.tile(order, n), pa.string()), pa.array(np.tile(steps, n))]
                columns += [pa.array(np.concatenate([f[i] for f in found]).astype(np.int64)) for i in range(len(COUNTS))]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *COUNTS])

    return parts.mapInArrow(rows_of, schema)
