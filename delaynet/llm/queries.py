"""The corpus queries by name: thin uses of the operators, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaynet.llm import chat, divergence, language, packing, resampling, secret_ledger, segmentations, simhash, syncmers, token_counts, toxicity, vantage, warc
from delaynet.session import scratch_path
from delaynet.sources.tables import table


def byte_bpe_files() -> dict[str, str]:
    return {
        "tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of all documents with their place, and the checksum of their ids."""
    cut = packing.pieces(docs, **byte_bpe_files())
    return packing.pack(cut, carry={"ids_crc32": F.crc32("ids")}).withColumn("piece", F.col("piece").cast("int"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


def toxicity_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.grade_texts(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.nearest(table(spark, sf_dir, "embeddings"))


def counted_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def sampled_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two samples of every text, with the checksum of their ids and whether they decode to the text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents")
    rows = segmentations.sampled(docs, model, decode=True)
    return rows.select(
        "doc_id", "sample", "n_tokens", "log_prob", "perturbed", "inclusion",
        F.crc32("ids").alias("ids_crc32"), F.crc32(F.encode("decoded", "UTF-8")).alias("text_crc32"),
    )


def closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare_neighbours(table(spark, sf_dir, "documents"))


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return found.select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


def chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair_roles(table(spark, sf_dir, "conversations"))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def secret_ledger_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against a ledger that starts empty."""
    found = secret_ledger.scan(table(spark, sf_dir, "documents"), scratch_path(spark, "ledger"))
    return secret_ledger.summary(found)


def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": language_id,
    "op2_toxicity": toxicity_grades,
    "op3_vantage_point_search": vantage_point_search,
    "op4_token_counts": counted_tokens,
    "op5_sampled_segmentations": sampled_segmentations,
    "op6_closed_syncmers": closed_syncmers,
    "op7_simhash_groups": simhash_groups,
    "op8_warc_revisits": warc_revisits,
    "op9_chat_repair": chat_repair,
    "op10_best_fit_packing": best_fit_packing,
    "op11_importance_resampling": importance_resampling,
    "op12_secret_ledger": secret_ledger_scan,
    "op13_source_divergence": source_divergence,
}
ORACLES = {"op12_secret_ledger": secret_ledger.SUMMARY_SQL, "op13_source_divergence": divergence.AUDIT_SQL}
