"""Queries of this package: one ``opN_<name>`` each, over whole tables.

Each takes (spark, sf_dir), reads its table in full and fixes the operator's
production parameters. ``ORACLE_SQL`` holds the DuckDB form where there is one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wapspark.llm import (byte_bpe, embedding_dedup, language_id, lexical_search,
                          license_scan, neighbours, ngram_join, packing, periodic_runs,
                          quality_rules, secret_scan, toxicity, url_filter)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# (verdict, host, path): a rule fits its host and all subdomains (fixed values).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"),
             ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES, across_hosts=True)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").filter(fold != 0))
    return toxicity.score(docs, model).select(
        "doc_id", (fold == 0).alias("held_out"), "score", "predicted", "offending")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(_table(spark, sf_dir, "documents"),
                            public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.PATTERN)


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(_table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language_id.fit(docs.filter(~held_out))
    return language_id.predict(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.group(_table(spark, sf_dir, "documents"), n=4, percent=85)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.runs(
        periodic_runs.planted(_table(spark, sf_dir, "documents"))))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"),
                                 _table(spark, sf_dir, "benchmark"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.group(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_url_filter,
    op2_license_scan,
    op3_packing,
    op4_toxicity,
    op5_byte_bpe,
    op6_neighbours,
    op7_quality_rules,
    op8_secret_scan,
    op9_language_id,
    op10_ngram_join,
    op11_periodic_runs,
    op12_lexical_search,
    op13_embedding_dedup,
)}

ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": license_scan.oracle_sql("documents"),
    "op7_quality_rules": quality_rules.oracle_sql("documents"),
    "op10_ngram_join": ngram_join.oracle_sql("documents"),
    "op13_embedding_dedup": embedding_dedup.oracle_sql("embeddings"),
    "op12_lexical_search": lexical_search.oracle_sql("documents", "benchmark"),
}
