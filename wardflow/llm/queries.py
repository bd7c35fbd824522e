"""The registered queries of this subpackage: each applies its operator with
production parameters to its whole table and derives the contract's columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import jaccard, simhash, toxicity
from wardflow.llm.common import table
from wardflow.llm.conversations import Repair, damage
from wardflow.llm.decontaminate import contained_items
from wardflow.llm.gated_lm import score_texts
from wardflow.llm.langid import identify, identify_pages
from wardflow.llm.packing import pack
from wardflow.llm.quality import score_quality
from wardflow.llm.secret_scan import digest
from wardflow.llm.tokens import count_tokens
from wardflow.llm.vector_codes import compress
from wardflow.llm.warc import read_records, write_bundles

VOCABULARY = "byte_bpe_50k.json"


def op1_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    return read_records(write_bundles(pages), with_payload=False).select(
        F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to_page").cast(kind).alias("refers_to"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), keep_ids=False)


def op3_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = F.crc32(F.col("doc_id").cast("string")) % 5
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic").where(part != 0))
    return toxicity.scan(docs, model).select(
        "doc_id", (part == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents")).withColumn("broken", F.array_join("broken", ","))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op6_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    got = score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return got.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents carry a declared language and a source (their host); they have no address."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    got = identify(docs, "text", declared=F.col("lang"), host=F.col("source"))
    return got.select("doc_id", F.col("lang").alias("declared"), "language", "language_p", F.col("language_kept").alias("kept"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def pages_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for web pages, with markup and address as evidence."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return identify_pages(pages).select("page_id", "language", "language_p", F.col("language_kept").alias("kept"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.join(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return Repair(damage(rows), rows).summary()


QUERIES = {f.__name__: f for f in (op1_warc_bundles, op2_packing, op3_toxic_segments, op4_quality_rules, op5_token_counts,
                                op6_gated_lm, op7_benchmark_decontamination, op8_language_id, op9_secret_scans,
                                op10_jaccard_join, op11_vector_codes, op12_simhash, op13_conversation_repair,
                                pages_language_id)}
