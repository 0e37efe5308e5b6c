"""Registered queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    bpe,
    decontam,
    embedding_dedup,
    fingerprints,
    hard_negatives,
    html_extract,
    license_scan,
    line_dedup,
    phrases,
    quality,
    simhash,
    token_counts,
    warc,
)
from orderlens.llm.common import table
from orderlens.session import scratch_path

SHINGLE_WORDS, MAX_BITS = 3, 3  # of SimHash near-dedup
KEEP_SCORE = 0.3

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_bpe(spark, sf_dir):
    """Token ids and decoded text of every document, as digests."""
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json")))


@query
def op2_html_extract(spark, sf_dir):
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op3_line_dedup(spark, sf_dir):
    """Every document without the runs of lines that occurred before."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, dropped_col="n_dropped")


@query
def op4_token_counts(spark, sf_dir):
    """Length histogram of all documents with the answers for every context limit."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    lengths = token_counts.token_lengths(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return token_counts.context_table(token_counts.histogram(lengths))


@query
def op5_warc(spark, sf_dir):
    """Every page written to WARC archives and read back through the index."""
    folder = scratch_path(spark, "warc")
    index = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op6_embedding_dedup(spark, sf_dir):
    """Links and groups of all vectors."""
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op7_license_scan(spark, sf_dir):
    """Every candidate line of every document with its license, if one is confirmed."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op8_decontaminate(spark, sf_dir):
    """Every document and benchmark item that it contains."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_simhash(spark, sf_dir):
    """Fingerprint and group of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), length=SHINGLE_WORDS, radius=MAX_BITS)


@query
def op10_quality(spark, sf_dir):
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (~F.coalesce(quality.learnable("doc_id"), F.lit(True))).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )


@query
def op11_hard_negatives(spark, sf_dir):
    """Hard negatives of every 100th vector; every 7th takes the next label first."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query
def op12_phrases(spark, sf_dir):
    """The best collocations of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op13_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))
