"""Helpers the operators share: reading tables, cutting plans, lookups of hot keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stampcard.session import scratch_path, tune

#: What separates words: space and the control characters from tab to return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


#: What a task sends to its Python worker at once. Both sides hold a batch, the
#: JVM outside its heap and twice over while the batch grows.
BATCH_BYTES = "8MB"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the plan: write ``df`` to the shared folder and read it back.

    A lost executor then costs its own tasks only, and the table's size is
    known to the optimizer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def extended(df: DataFrame, fields: str) -> tuple[DataFrame, StructType]:
    """``df`` without columns of the new fields' names, and its schema with
    the new fields: what an operator adds replaces columns of that name."""
    new = StructType.fromDDL(fields)
    rest = df.drop(*new.names)
    return rest, StructType(rest.schema.fields + new.fields)


def text_key(*columns: Column) -> list[Column]:
    """Two 64-bit hashes of the columns' values, as ``k1`` and ``k2``."""
    return [
        F.xxhash64(*columns).alias("k1"),
        F.xxhash64(F.lit("second"), *columns).alias("k2"),
    ]


def crc_part(id_column: Column, parts: int) -> Column:
    """Remainder of the CRC-32 of an id written as text; -1 for a null id."""
    return F.coalesce(
        F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(parts)).cast("int"), F.lit(-1)
    )


def salted_lookup(
    rows: DataFrame, facts: DataFrame, on: list[str], spread_by: list[str], salts: int = 8
) -> DataFrame:
    """Left join of ``rows`` to ``facts``, which has one row per ``on``.

    The rows of one key are dealt over ``salts`` join keys. Both sides are then
    shuffled for the join, so adaptive execution can split what is still hot.
    """
    spread = rows.withColumn("__salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = facts.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*on, "__salt"], "left").drop("__salt")


def query_groups(spark: SparkSession, queries: int, blocks: int, most: int, least: int) -> int:
    """Into how many groups the queries of a search are dealt. A block is sent
    to every group, so groups are as large as a task may hold (``most``), but
    there are enough of them to occupy the cluster, of ``least`` each."""
    fill = math.ceil(spark.sparkContext.defaultParallelism / max(1, blocks))
    return max(1, math.ceil(queries / most), min(fill, math.ceil(queries / least)))
