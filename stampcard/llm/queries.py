"""Named queries of the operators, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stampcard.llm.collision_ann import nearest_neighbours
from stampcard.llm.common import crc_part, table, written
from stampcard.llm.filter_audit import audit, mask_counts
from stampcard.llm.hamming_topk import nearest_codes, sign_code
from stampcard.llm.language_id import fit_languages, identify
from stampcard.llm.line_dedup import dedup_lines
from stampcard.llm.markov_lm import score_texts
from stampcard.llm.minhash_join import near_duplicates
from stampcard.llm.mixing import mix_sources
from stampcard.llm.piece_encoding import encode, read_model
from stampcard.llm.secret_scan import SecretPlan, candidates, dictionary, format_labels, score_findings, train_forest
from stampcard.llm.toxicity import ToxicityModel, fit_toxicity, score_toxicity
from stampcard.llm.turn_repair import damaged, repair_report
from stampcard.llm.warc import round_trip


#: A public BPE model; the path is a parameter wherever it is used.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = PIECE_MODEL) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode(docs, read_model(model_path), verify=True)
    return encoded.select("doc_id", F.size("piece_ids").alias("n_pieces"), "piece_ids", "same_text")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    records = round_trip(
        pages.select(F.col("page_id").alias("id"), F.col("url").alias("uri"), F.col("html").cast("binary").alias("payload"))
    )
    return records.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign codes of the embeddings; every twentieth is a query."""
    codes = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), sign_code(F.col("embedding")).alias("code")
    )
    return nearest_codes(codes, codes.filter("id % 20 = 0")).withColumnRenamed("id", "vec_id")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("__lines").cast("bigint").alias("n_lines"),
        F.col("__removed").cast("bigint").alias("n_removed"),
        "text",
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_part(F.col("doc_id"), 3) == 1
    model = fit_languages(docs.filter(~held_out).select("text", "lang"))
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op6_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.filter("vec_id % 50 = 0"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in all documents; the forest learns from the findings of four
    fifths of them whose format leaves no doubt."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("path"), "text")
    held_out = crc_part(F.col("doc_id"), 5) == 0
    words = dictionary(docs.filter(~held_out).select("text"), SecretPlan())
    findings = written(candidates(docs, words), "secret-findings")
    forest = train_forest(format_labels(findings).filter(~held_out))
    return score_findings(findings, forest).select(
        "doc_id", "begin", F.octet_length("value").alias("n_bytes"), "name", F.round("score", 9).alias("score"), "is_secret"
    )


def op8_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("source")


def toxicity_model(spark: SparkSession, sf_dir: str) -> ToxicityModel:
    """Learned from the labelled documents that are not held out."""
    # Of several labels of a document the strictest counts.
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fit_toxicity(docs.filter(crc_part(F.col("doc_id"), 5) > 0), labels=labels)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, toxicity_model(spark, sf_dir))
    return scored.select(
        "doc_id",
        (crc_part(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def op11_markov_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, crc_part(F.col("doc_id"), 10) == 0)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair_report(damaged(rows), rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_warc": op2_warc,
    "op3_hamming_topk": op3_hamming_topk,
    "op4_line_dedup": op4_line_dedup,
    "op5_language_id": op5_language_id,
    "op6_collision_ann": op6_collision_ann,
    "op7_secret_scan": op7_secret_scan,
    "op8_minhash_join": op8_minhash_join,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_markov_lm": op11_markov_lm,
    "op12_filter_audit": op12_filter_audit,
    "op13_turn_repair": op13_turn_repair,
}
