"""Registered queries of the text operators: thin, each from its operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelspark.llm import (
    embeddings, importance, jaccard, line_dedup, mixing, packing, quality_rules, sentencepiece, sharding, site_quality,
    spelling, toxicity, warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages")).drop("archive")


@_query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(_table(spark, sf_dir, "documents")).withColumn(
        "failed_rules", F.array_join("failed_rules", ",")
    )


@_query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


@_query
def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=8)


@_query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(_table(spark, sf_dir, "documents"), size=3, pct=90)


@_query
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.9)


@_query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = sentencepiece.encode_checked(docs, ["doc_id"])
    return encoded.select("doc_id", "n_tokens", "token_ids", "round_trip")


@_query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


@_query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@_query
def op2_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return site_quality.classify_quality(docs, labels, host="source", path="lang")


@_query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


@_query
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), pct=25)
    return scored.select("doc_id", "n_features", "weight", "score", "rank")


@_query
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), capacity=1024)
