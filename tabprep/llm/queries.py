"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm import (fingerprints, jaccard_join, license_scan, line_dedup, merkle, mixing, packing, pii, prefix_trie, quality, substring_dedup,
                         token_records, warc)
from tabprep.llm.common import table


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked at Jaccard 0.9 of their 3-word shingles."""
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of every text, and all spans with those the trees add."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = pii.detect(docs, pii.fit(docs)).drop("text")
    count = lambda kind: F.size(F.filter("_base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return got.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(pii.listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("_all")).alias("spans"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every text once shared 13-word windows are removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup(docs, digest=True).withColumnRenamed("kept", "kept_sha256")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts and rules, and the calibrated classifier's verdict."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fitted(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs.select("doc_id", "text"), model).drop("text")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed of every text: an equal or near line starts earlier."""
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and packed into sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as record files and read back."""
    return token_records.roundtrip(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A capture per page, written as WARC archives and read back."""
    got = warc.captures(warc.write(table(spark, sf_dir, "pages")), with_blocks=False)
    return got.select(F.col("capture_key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the weighted mix takes of each document."""
    return mixing.taken(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and folded root of every document."""
    return merkle.audit(table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases of every text, and labels of the templates it holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.report(docs, license_scan.fit(docs))


QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_fingerprints": op2_fingerprints,
    "op3_pii": op3_pii,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_line_dedup": op6_line_dedup,
    "op7_packing": op7_packing,
    "op8_token_records": op8_token_records,
    "op9_warc": op9_warc,
    "op10_source_mix": op10_source_mix,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merkle": op12_merkle,
    "op13_license_scan": op13_license_scan,
}

ORACLE = {
    "op1_jaccard_join": jaccard_join.CLASS_SQL,
    "op4_substring_dedup": substring_dedup.KEPT_SQL,
    "op6_line_dedup": line_dedup.REMOVED_SQL,
    "op9_warc": warc.PAGE_SQL,
    "op10_source_mix": mixing.taken_sql(),
    "op11_prefix_trie": prefix_trie.NODE_SQL,
    "op12_merkle": merkle.audit_sql(),
}
