"""Corpus pipeline: from raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir), where docs has the columns of
``documents``, and returns the next stage's docs; the last returns the packed
pieces. A stage works on all that its predecessor kept, and texts change as
lines go (n_chars follows). Whole documents pass through Python workers in
batches of ``ROWS``; stages are lazy, so that setting stays in the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm import jaccard_join, line_dedup, mixing, packing, quality
from tabprep.llm.common import stored, table

#: Near duplicates among documents: five words, Jaccard 0.8 or more.
NEAR_WIDTH, NEAR_PERCENT = 5, 80
#: Whole documents that Python workers take at a time.
ROWS = 512


def in_batches(spark: SparkSession, rows: int) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the calibrated classifier."""
    in_batches(spark, ROWS)
    model = quality.fitted(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model).filter("kept").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an equal or near line precedes; documents that
    lose every line go."""
    cut = line_dedup.dedup(docs).filter(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]")) > 0)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that n-gram Jaccard links join."""
    in_batches(spark, ROWS)
    return jaccard_join.one_of_each(docs, NEAR_WIDTH, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weighted mix of sources takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of at most 1024 ids."""
    in_batches(spark, ROWS)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard", one_of_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack),
]

#: The classifier's verdict and the packing are not SQL; tests/llm compares
#: the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written once in
    the shared folder, so the next reads it instead of computing it again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
