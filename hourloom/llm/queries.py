"""The registered queries: each applies one operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.llm import (bpe_codec, conversation_repair, decontamination, licenses, lm_scoring, oracles,
                          quality_ranking, quality_rules, secret_scan, simhash, source_divergence, substring_dedup,
                          token_counts, warc)
from hourloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def remainder(column: str, divisor: int):
    """crc32 of the id as text, modulo ``divisor`` (null ids: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


@register
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deleted-interpolation bigram scores of all documents; remainder 2 of 7 is never learned from,
    remainder 5 is the deleted part."""
    docs = table(spark, sf_dir, "documents")
    rest = remainder("doc_id", 7)
    scored = lm_scoring.score(docs, F.coalesce(rest != 2, F.lit(True)), rest == 5, order=2)
    return scored.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


@register
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verified overlaps of all documents with all benchmark items, by spaced seeds."""
    found = decontamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("k")


@register
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template spans in all documents, by diagonal voting."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@register
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in 20-word windows that also start earlier, removed; a digest of what is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@register
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens per document of the byte-level vocabulary, by heap-and-linked-list merging."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 4-word shingles, at most 4 differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4).select(
        "doc_id", "fingerprint", "component_id")


@register
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode each document by tree reduction, decode the ids again, digest both."""
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe_codec.encode_documents(table(spark, sf_dir, "documents"), ranks, pattern)
    return bpe_codec.digests(bpe_codec.decode_documents(encoded, ranks, pattern))


@register
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bradley-Terry quality scores of all documents, learned outside the held-out third."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_ranking.fit(docs, labels, remainder("doc_id", 3) != 1)
    return quality_ranking.classify(docs, model).select(
        "doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


@register
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The threshold table over all documents, with the counts it reads."""
    return quality_rules.apply_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failed_rules")


@register
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, equal payloads once, and read back by byte ranges."""
    return warc.archive_and_read(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by the contract's rule and repaired at the least cost."""
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_digests(damaged).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@register
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern matches and high-entropy spans of all documents."""
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [secret_scan.count_of(k).alias(f"n_{k}") for k in secret_scan.KINDS]
    return found.select("doc_id", *counts, F.sha2(secret_scan.listed(kinds=secret_scan.KINDS).cast("binary"), 256)
                        .alias("base_sha256"), secret_scan.listed().alias("spans"))


@register
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every (lang, source) group from its language's other sources, and its own terms."""
    return source_divergence.divergences(table(spark, sf_dir, "documents"))


ORACLE["op10_warc"] = """
WITH p AS (SELECT page_id, coalesce(encode(html), ''::BLOB) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p),
m AS (SELECT payload_digest, payload_bytes, max(page_id) AS last FROM d GROUP BY ALL)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN d.payload_bytes >= 1000 AND d.page_id < m.last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.payload_bytes >= 1000 AND d.page_id < m.last THEN m.last END AS refers_to
FROM d JOIN m USING (payload_digest, payload_bytes)
"""

ORACLE["op3_license_scan"] = oracles.license_scan_sql()
ORACLE["op4_substring_dedup"] = oracles.SUBSTRING_DEDUP
ORACLE["op9_quality_rules"] = oracles.quality_rules_sql()
ORACLE["op11_conversation_repair"] = oracles.conversation_repair_sql()
ORACLE["op13_source_divergence"] = oracles.SOURCE_DIVERGENCE
