"""The operators over the test tables, by query name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (
    exact_dedup, hard_negatives, jaccard, license, metric_join, mixing, ordinal, periodic, pieces, quality, recompression, sharding, warc,
)
from touchline.llm.rows import table
from touchline.llm.sql import ORACLES


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.grouped(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license.scan(table(spark, folder, "documents"))


def op3_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    """Both records of each page; the serialised record is returned as its digest and length."""
    records = warc.derivatives(warc.responses(table(spark, folder, "pages")))
    return records.select(
        *[c for c in records.columns if c != "record"], F.sha2("record", 256).alias("record_sha256"), F.length("record").alias("record_length")
    )


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.groups(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op6_recompression(spark: SparkSession, folder: str) -> DataFrame:
    return recompression.digests(table(spark, folder, "documents"))


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trips(table(spark, folder, "documents"))


def op8_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return ordinal.scored(docs, ordinal.train(docs, table(spark, folder, "labels")))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.mixed(table(spark, folder, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.digests(table(spark, folder, "documents"))


def op12_metric_join(spark: SparkSession, folder: str) -> DataFrame:
    return metric_join.near_vectors(table(spark, folder, "embeddings"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mined(hard_negatives.relabelled(table(spark, folder, "embeddings")))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, query in globals().items() if name.startswith("op")}


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
