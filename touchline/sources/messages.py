"""Message sources: a Kafka topic or any stream shaped like one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import schemas


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topics: list[str],
    starting_offsets: str = "latest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Kafka stream; the connector has to be on the cluster's class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def file_messages(
    spark: SparkSession, path: str, topic: str, max_files: int | None = 1, latest_first: bool = False
) -> DataFrame:
    """Text files, one message per line, shaped like a topic: value, timestamp, topic."""
    reader = spark.readStream.option("latestFirst", latest_first)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select(
        F.col("value"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
        F.lit(topic).alias("topic"),
    )


def of_topic(messages: DataFrame, topic: str | None) -> DataFrame:
    return messages if topic is None else messages.filter(F.col("topic") == topic)


def parsed(messages: DataFrame, schema: T.StructType, topic: str | None = None, name: str = "event") -> DataFrame:
    """Payload of each message under one struct column, next to its arrival time in milliseconds."""
    arrival: Column = F.unix_millis(F.col("timestamp").cast("timestamp"))
    return of_topic(messages, topic).select(
        arrival.alias("_arrival_ms"), F.from_json(F.col("value").cast("string"), schema).alias(name)
    )


def event_messages(messages: DataFrame, topic: str | None = None) -> DataFrame:
    return parsed(messages, schemas.EVENT_MESSAGE, topic)


def match_information_messages(messages: DataFrame, topic: str | None = None) -> DataFrame:
    return parsed(messages, schemas.MATCH_INFORMATION, topic, name="document")
