"""The corpus pipeline: documents to a mixed and tokenised training set.

Each stage reads what the one before wrote, judges all of it, and returns the rows that go on with the columns of ``documents``; the last adds
the token ids. ``run`` writes each stage's rows as Parquet under a new folder of the shared checkpoint folder and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline.catalog.tables import work_folder
from touchline.llm import exact_dedup, jaccard, mixing, pieces, quality
from touchline.llm.rows import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the calibrated cutoffs."""
    return quality.filtered(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id."""
    return exact_dedup.deduplicated(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id."""
    return jaccard.representatives(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for; repeats are rows of their own."""
    return mixing.emitted(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row with its SentencePiece ids."""
    return pieces.encoded(docs)


STAGES = [
    ("quality_rules", quality_rules), ("exact_dedup", exact_copies), ("ngram_jaccard", near_copies), ("mixing", source_mix),
    ("sentencepiece", tokens),
]

#: SQL can express neither the near copies nor the tokens; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs, folder = table(spark, sf_dir, "documents"), work_folder(spark)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
