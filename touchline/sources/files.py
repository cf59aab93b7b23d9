"""File and table sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import schemas


def _reader(spark: SparkSession, streaming: bool, max_files: int | None = None):
    if not streaming:
        return spark.read
    reader = spark.readStream
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def time_major_records(
    spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None
) -> DataFrame:
    """JSON lines, one record per frame with the array of its entities."""
    return _reader(spark, streaming, max_files).schema(schemas.TIME_MAJOR_RECORD).json(path)


def match_documents(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    max_files: int | None = None,
    name_filter: str | None = None,
) -> DataFrame:
    """Match information XML; ``source_file`` keeps the order of the documents."""
    reader = _reader(spark, streaming, max_files).format("xml").schema(schemas.MATCH_INFORMATION_XML)
    reader = reader.option("rowTag", "MatchInformation").option("encoding", "UTF-8")
    if name_filter is not None:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path).select("*", F.col("_metadata.file_path").alias("source_file"))


def match_overrides(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per match; a file without ``match_id`` is named after its match.

    A document that cannot be parsed has no content and is left out.
    """
    schema = (
        "match_id string, home_team_id string, guest_team_id string, pitch_x double, pitch_y double, _corrupt string"
    )
    raw = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("pathGlobFilter", "*.json")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json(path)
        .select("*", F.col("_metadata.file_name").alias("file_name"))
    )
    return raw.filter(F.col("_corrupt").isNull()).select(
        named_override("match_id", "file_name"), "pitch_x", "pitch_y", "home_team_id", "guest_team_id"
    )


def named_override(match_id: str, file: str) -> Column:
    """The match of an override document: its own id, else the name of its file."""
    return F.coalesce(F.nullif(F.col(match_id), F.lit("")), F.regexp_extract(file, r"^(.*)\.json$", 1)).alias("match_id")


def stage_table(spark: SparkSession, location: str, schema: T.StructType | None = None) -> DataFrame:
    """An upstream stage, by parquet path or by catalog name.

    With a schema the match id read from folder names stays text even where it looks like a number.
    """
    if "/" not in location:
        return spark.read.table(location)
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.parquet(location)
    return table if schema is None else table.select(*schema.names)
