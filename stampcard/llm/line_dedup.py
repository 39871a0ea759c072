"""Removing boilerplate lines that many sites share, by distinct-site spread.

Each distinct line gets a small HyperLogLog sketch of the sites it occurs on;
sketches merge in the aggregation, map side first. A sketch's used registers
never outnumber the sites, so an estimate at or above ``certain_estimate``
proves the spread. Lines with enough occurrences and more than one site that
are not proven by their sketch get an exact distinct count. So every decision
is the exact one, and exact counting is left to lines near the threshold.

A line of ``min_sites`` sites or more is removed from all documents but the
first that has it (smallest id, then position), so that no content is lost.

Defined results: lines end at line feeds; blank lines stay; a null site is a
site of its own; a null text stays null; equal rows (id and text) count as one
document and get equal results; null ids come last.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stampcard.llm.common import text_key, written

#: Lines on this many sites are boilerplate.
MIN_SITES = 8


def sketch_size(min_sites: int) -> tuple[float, int]:
    """Relative error to ask for, and the estimate that proves the spread.

    ``approx_count_distinct`` has 2^p registers, p = ceil(2 log2(1.106 / error)).
    While the sketch is sparse its estimate is m ln(m / unused), rounded.
    """
    p = 5
    while min_sites > 0.4 * 2**p:
        p += 1
    m = 2**p
    estimate = lambda used: round(m * math.log(m / (m - used)))
    return 1.106 / 2 ** ((p - 0.5) / 2), max(estimate(min_sites), estimate(min_sites - 1) + 1)


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """Keys ``h`` of the lines found on ``min_sites`` sites or more.

    ``lines`` has one row per occurrence: ``h``, and the site as ``site`` (long).
    """
    error, certain_estimate = sketch_size(min_sites)
    sketched = written(
        lines.groupBy("h")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.approx_count_distinct("site", error).alias("estimate"),
            (F.min("site") != F.max("site")).alias("several"),
        )
        .filter((F.col("n") >= min_sites) & (F.col("several") | F.lit(min_sites <= 1)))
        .select("h", (F.col("estimate") >= certain_estimate).alias("certain")),
        "line-spread",
    )
    certain = sketched.filter("certain").select("h")
    near = sketched.filter("not certain").select("h")
    counted = (
        lines.join(near, "h", "left_semi")
        .select("h", "site")
        .distinct()
        .groupBy("h")
        .count()
        .filter(F.col("count") >= min_sites)
        .select("h")
    )
    return written(certain.unionByName(counted), "line-boilerplate")


def dedup_lines(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    id_column: str = "doc_id",
    site_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, and two columns
    more: ``__lines`` and ``__removed``, the number of lines before and removed."""
    key = text_key(F.col(id_column), F.col(text_column))
    line = F.col("line")
    lines = (
        docs.select(
            F.col(id_column).alias("d"),
            *key,
            F.when(F.col(site_column).isNotNull(), F.xxhash64(site_column)).otherwise(0).alias("site"),
            F.posexplode(F.split(text_column, "\n")).alias("pos", "line"),
        )
        .filter(F.trim(line) != "")
        .select("d", "k1", "k2", "site", "pos", F.unhex(F.md5(line.cast("binary"))).alias("h"))
    )
    spread = spread_lines(lines.select("h", "site"), min_sites)
    found = written(
        lines.select("h", "d", "k1", "k2", "pos").join(spread, "h", "left_semi"), "line-occurrences"
    )
    order = F.struct(F.col("d").isNull(), "d", "k1", "k2", "pos")
    first = found.groupBy("h").agg(F.min(order).alias("f")).select("f.k1", "f.k2", "f.pos")
    each = found.select("k1", "k2", "pos", F.lit(1).alias("n")).unionByName(
        first.select("k1", "k2", "pos", F.lit(0).alias("n"))
    )
    removed = (
        each.groupBy("k1", "k2", "pos")
        .agg(F.min("n").alias("gone"))
        .filter("gone = 1")
        .groupBy("k1", "k2")
        .agg(F.collect_list("pos").alias("__gone"))
    )
    rest = [c for c in docs.columns if c != text_column]
    split = docs.select(
        *rest, key[0].alias("__k1"), key[1].alias("__k2"), F.split(text_column, "\n").alias("__all")
    )
    joined = split.join(
        removed.withColumnsRenamed({"k1": "__k1", "k2": "__k2"}), ["__k1", "__k2"], "left"
    )
    total = F.when(F.col("__all").isNull(), 0).otherwise(F.size("__all"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__all") - 1), F.col("__gone"))
    text = F.when(F.col("__gone").isNull(), F.array_join("__all", "\n")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col("__all"), i)), "\n")
    )
    return joined.select(
        *[text.alias(c) if c == text_column else F.col(c) for c in docs.columns],
        total.alias("__lines"),
        F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).alias("__removed"),
    )
