"""From raw documents to packed training sequences.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir) and returns a
frame that is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wapspark.llm import ngram_join, packing, quality_rules, secret_scan, toxicity
from wapspark.session import remove_path, scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5, by a model of the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.keep(docs, toxicity.fit(docs, labels.select("doc_id", "toxic")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents (Jaccard 0.8 or more of their sets of
    five-word sequences) the one with the least id; a document that stands twice
    is one. Rows without an id can't be named and stay, all of them."""
    groups = ngram_join.group(docs, n=5, percent=80)
    first = groups.filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.filter("doc_id is not null").join(first, "doc_id", "left_semi")
    kept = kept.withColumn("text_hash", F.xxhash64("text")).dropDuplicates(
        ["doc_id", "text_hash"]).select(*docs.columns)
    return kept.unionByName(docs.filter("doc_id is null"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets' spans replaced by a mark."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", keep_quality),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

# Learned scores, hashes of token ids and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; a stage's table goes once the next
    one is written."""
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return docs
