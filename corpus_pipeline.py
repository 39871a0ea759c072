"""The corpus pipeline: five stages of the training-data operators in order.

Each stage takes the documents its predecessor kept, with the columns of
``documents``, and returns documents with the same columns; the last one adds
the pieces. Columns beyond ``doc_id, text, lang, source`` are passed through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stampcard.llm.common import table, written
from stampcard.llm.line_dedup import dedup_lines
from stampcard.llm.minhash_join import near_duplicates
from stampcard.llm.mixing import mixed
from stampcard.llm.piece_encoding import encode, read_model
from stampcard.llm.queries import PIECE_MODEL, toxicity_model
from stampcard.llm.toxicity import score_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are scored toxic. Null and empty texts stay."""
    # Under other names, as a column may be called as one that the scores add.
    rows = docs.select([F.col(name).alias(f"__{name}") for name in docs.columns])
    scored = score_toxicity(rows, toxicity_model(spark, sf_dir), "__text", keep_text=True)
    return scored.filter("score < 0.5").select([F.col(f"__{name}").alias(name) for name in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take lines that many sources share out of all documents but the first."""
    return dedup_lines(docs).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: that of the smallest
    id, and of equal ids that of the smallest hash of its text. Every row is a
    document of its own, with or without an id; those without words stay."""
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()), "pipeline-rows")
    found = near_duplicates(rows, id_column="__row").filter("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text").alias("hash"), "__row")
    named = rows.select("__row", order.alias("order")).join(
        found.select(F.col("doc_id").alias("__row"), "component_id"), "__row"
    )
    chosen = named.groupBy("component_id").agg(F.min("order").alias("order")).select("order.__row")
    # The chosen ids grow with the rows: one plan at every size, without a broadcast.
    kept = rows.join(written(chosen, "pipeline-chosen").hint("merge"), "__row", "left_semi")
    return kept.unionByName(rows.filter(_wordless())).select(docs.columns)


def _wordless() -> Column:
    return F.coalesce(F.regexp_instr("text", F.lit(r"[^\x20\x09-\x0D]")) == 0, F.lit(True))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents, so that the sources meet their targets.
    Documents without words count for no target; they stay, once."""
    return mixed(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the texts; ``same_text`` tells that decoding gives them back."""
    return encode(docs, read_model(PIECE_MODEL), verify=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("piece_encoding", piece_encoding),
]

#: SQL can express neither the classifier nor the encoding; the stages are
#: tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
