"""Kafka source and sink. The connector package must be on the class path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stampcard.config import EngineConfig
from stampcard.sources.wire import kafka_records


def source_options(cfg: EngineConfig) -> dict[str, str]:
    """From the first offset on, committed records only. Spark keeps the
    offsets in its own checkpoint, so nothing is committed to the broker."""
    options = {
        "kafka.bootstrap.servers": cfg.kafka_bootstrap_servers,
        "subscribe": cfg.kafka_topic,
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
        "kafka.group.id": cfg.kafka_group_id,
    }
    if cfg.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(cfg.max_offsets_per_trigger)
    return options


def sink_options(cfg: EngineConfig) -> dict[str, str]:
    """Spark's Kafka sink is at-least-once; consumers drop repeats by
    transaction id, which ``id_mode="deterministic"`` keeps equal on replay."""
    return {
        "kafka.bootstrap.servers": cfg.kafka_bootstrap_servers,
        "topic": cfg.kafka_output_topic,
    }


def arrival_seq() -> Column:
    """One number that orders records by partition, then offset."""
    return F.shiftleft(F.col("partition").cast("bigint"), 48).bitwiseOR(F.col("offset"))


def raw_records(records: DataFrame) -> DataFrame:
    """Value text and arrival order of broker records, from any source with
    the columns ``value``, ``partition`` and ``offset``."""
    return records.select(F.col("value").cast("string").alias("value"), arrival_seq().alias("arrival_seq"))


def read_checkin_stream(spark: SparkSession, cfg: EngineConfig) -> DataFrame:
    records = spark.readStream.format("kafka").options(**source_options(cfg)).load()
    return raw_records(records)


def write_transactions(transactions: DataFrame, cfg: EngineConfig) -> None:
    """Send one batch of transactions, keyed by user."""
    kafka_records(transactions).write.format("kafka").options(**sink_options(cfg)).save()
