"""Table and message sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_by_match(
    df: DataFrame, path: str, frame: str = "frame_id", frames_per_file: int = 20_000, mode: str = "overwrite",
    options: dict[str, str] | None = None,
) -> None:
    """Parquet partitioned by match, in files of a block of frames each.

    One match is spread over as many tasks as it has blocks, so a match that holds much of the
    data is no bottleneck, and no task writes a small file for every match. The frames of a
    block lie together, so later stages combine them before their shuffle.
    """
    blocked = df.withColumn("_block", F.floor(F.col(frame) / frames_per_file))
    # Unlike a plain repartition, adaptive execution may split the large partitions of this one.
    spread = blocked.hint("rebalance", "match_id", "_block").sortWithinPartitions("match_id", frame)
    spread.drop("_block").write.mode(mode).options(**options or {}).partitionBy("match_id").parquet(path)


def as_messages(df: DataFrame, columns: list[str]) -> DataFrame:
    """``key`` (the match, when listed) and a JSON ``value`` of exactly the listed columns."""
    value = F.to_json(F.struct(*columns)).alias("value")
    if "match_id" in columns:
        return df.select(F.col("match_id").cast("string").alias("key"), value)
    return df.select(value)


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def arrival_order(df: DataFrame, arrival: str = "_arrival_ms") -> DataFrame:
    """Rows of each partition in the order of arrival, unknown arrivals last."""
    if arrival not in df.columns:
        df = df.withColumn(arrival, F.lit(None).cast("bigint"))
    return df.sortWithinPartitions(F.col(arrival).asc_nulls_last())
