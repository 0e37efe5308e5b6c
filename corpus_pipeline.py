"""Corpus cleaning pipeline: quality, line dedup, near dedup, decontamination, encoding.

Each stage is (spark, docs, sf_dir) -> DataFrame and works on all the rows its predecessor kept.
All but the last return the columns of ``documents``; the last returns the encoded documents'
digests. Nulls, empty texts, repeated rows and empty tables: as each operator defines.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import bpe, decontam, line_dedup, quality, simhash
from orderlens.llm.common import table
from orderlens.llm.queries import KEEP_SCORE, MAX_BITS, SHINGLE_WORDS
from orderlens.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.drop_rejected(docs, quality.fit(docs, table(spark, sf_dir, "labels")), threshold=KEEP_SCORE)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that occurred before go; n_chars follows the text."""
    cleaned = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.drop_near_duplicates(docs, length=SHINGLE_WORDS, radius=MAX_BITS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.digests(bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]

#: The classifier's training, fingerprints and byte-pair merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    root = scratch_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
