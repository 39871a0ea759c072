"""Mixing sources to target weights by hash-threshold histograms.

Every row has a point, a 60-bit hash of its id. A source's share is met by
taking the rows whose point lies below a threshold. The threshold is found
without sorting rows: words are summed by source and hash bucket, running sums
over the buckets show the bucket in which the budget ends, and only that
bucket's rows are summed again by finer buckets, until a single point is left.
Budgets above a source's size take every row once and meet the rest by the
threshold, so a larger budget takes all that a smaller one takes.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; rows with equal ids share a point and are taken together; a
null id hashes as the empty text; without rows, or without words, nothing is
taken.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stampcard.llm.common import WORD_PATTERN, written

POINT_BITS = 60


@dataclass(frozen=True)
class MixPlan:
    """``weights`` repeat over the sources in code-point order, ``share`` is the
    budget as a part of all words, ``most`` limits how often a row is taken."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most: int = 2
    bucket_bits: int = 10


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)).cast("bigint"), F.lit(0).cast("bigint"))


def point_of(doc_id: Column) -> Column:
    """The first 60 bits of the id's MD5."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, POINT_BITS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, plan: MixPlan) -> DataFrame:
    """``source, source_size`` with ``target``: one row per source.

    The budget is dealt by weight; a target stops at ``most`` times the source's
    size and the excess goes to the others. In the order of size per weight the
    sources that stop are a prefix, so running sums give the common level.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in plan.weights])
    place = F.row_number().over(by_name)
    ranked = sizes.select(
        "source",
        "source_size",
        place.alias("place"),
        F.element_at(weights, (F.pmod(place - 1, F.lit(len(plan.weights))) + 1)).alias("weight"),
        (F.col("source_size") * plan.most).cast("double").alias("limit"),
    ).withColumn("full_at", F.col("limit") / F.col("weight"))
    order = Window.orderBy("full_at", "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (
        F.sum("source_size").over(whole).cast("double") * plan.share
        - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = ranked.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "place", "level"))
    return levels.withColumn("chosen", F.min(fits).over(whole)).select(
        "source",
        "source_size",
        F.coalesce(
            F.least("limit", F.col("weight") * F.col("chosen.level")), F.col("limit")
        ).alias("target"),
    )


def _boundaries(rows: DataFrame, budgets: DataFrame, plan: MixPlan) -> DataFrame:
    """Per source the interval of points ``[low, high)`` in which the budget
    ends: ``words`` in it, ``before`` it, and the number of ``points``.

    Sources without words have no interval.
    """
    found = budgets.select(
        F.col("source").alias("b_source"),
        "rest",
        F.lit(0).cast("bigint").alias("low"),
        F.lit(1 << POINT_BITS).cast("bigint").alias("high"),
        F.lit(0).cast("bigint").alias("before"),
    )
    shift = POINT_BITS
    while True:
        shift = max(0, shift - plan.bucket_bits)
        inside = rows.filter("size > 0").join(
            found,
            F.col("source").eqNullSafe(F.col("b_source"))
            & (F.col("point") >= F.col("low"))
            & (F.col("point") < F.col("high")),
        )
        bucket = F.shiftright("point", shift)
        sums = inside.groupBy("source", bucket.alias("bucket")).agg(
            F.sum("size").alias("words"),
            F.min("point").alias("first_point"),
            F.max("point").alias("last_point"),
            F.first("before").alias("base"),
            F.first("rest").alias("rest"),
        )
        running = Window.partitionBy("source").orderBy("bucket")
        upto = F.col("base") + F.sum("words").over(running)
        last = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("bucket"))) == 1
        ends = (
            sums.withColumn("upto", upto)
            .withColumn("last", last)
            .filter(
                (F.col("upto") - F.col("words") <= F.col("rest"))
                & ((F.col("upto") > F.col("rest")) | F.col("last"))
            )
        )
        found = written(
            ends.select(
                F.col("source").alias("b_source"),
                "rest",
                F.shiftleft("bucket", shift).alias("low"),
                F.shiftleft(F.col("bucket") + 1, shift).alias("high"),
                (F.col("upto") - F.col("words")).alias("before"),
                "words",
                (F.col("first_point") != F.col("last_point")).alias("open"),
            ),
            "mix-boundary",
        )
        if shift == 0 or not found.filter("open").head(1):
            return found
        found = found.select("b_source", "rest", "low", "high", "before")


def _sized(docs: DataFrame, id_column: str, source_column: str, text_column: str) -> DataFrame:
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("source"),
        word_count(F.col(text_column)).alias("size"),
        point_of(F.col(id_column)).alias("point"),
    )
    return written(rows, "mix-sizes")


def source_thresholds(rows: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """``t_source, source_size, target, times, threshold``: a row is taken
    ``times`` times, and once more if its point is below the threshold.

    Of the row that crosses a budget, the side nearer to the budget is chosen.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes, plan), "mix-targets")
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budgets = targets.withColumn("times", times.cast("bigint")).withColumn(
        "rest", F.col("target") - F.col("times") * F.col("source_size")
    )
    ends = _boundaries(rows, budgets, plan)
    nearer = F.col("before") + F.col("words") - F.col("b.rest") < F.col("b.rest") - F.col("before")
    return written(
        budgets.alias("a")
        .join(ends.alias("b"), F.col("a.source").eqNullSafe(F.col("b.b_source")), "left")
        .select(
            F.col("a.source").alias("t_source"),
            "source_size",
            "target",
            "times",
            F.coalesce(F.when(nearer, F.col("high")).otherwise(F.col("low")), F.lit(0)).alias("threshold"),
        ),
        "mix-thresholds",
    )


def mix_sources(
    docs: DataFrame,
    plan: MixPlan = MixPlan(),
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target,
    taken``, ``taken`` being the words the mix takes, repeats counted."""
    rows = _sized(docs, id_column, source_column, text_column)
    thresholds = source_thresholds(rows, plan)
    once_more = (F.col("point") < F.col("threshold")).cast("bigint")
    return rows.join(thresholds, F.col("source").eqNullSafe(F.col("t_source"))).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("times") + once_more)).alias("taken"),
    )


def mixed(docs: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them; those without words
    once. Texts stay where they are: what a row needs to know is its source's
    threshold, one row per source."""
    thresholds = source_thresholds(_sized(docs, "doc_id", "source", "text"), plan).select(
        F.col("t_source").alias("__source"), F.col("times").alias("__least"), F.col("threshold").alias("__threshold")
    )
    once_more = (point_of(F.col("doc_id")) < F.col("__threshold")).cast("bigint")
    times = F.when(word_count(F.col("text")) > 0, F.col("__least") + once_more).otherwise(1).cast("int")
    known = docs.join(thresholds, F.col("source").eqNullSafe(F.col("__source")))
    return known.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), times))).select(docs.columns)
