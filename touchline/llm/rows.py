"""Small helpers for whole tables: names, row numbers and size-checked removal of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.catalog.tables import work_folder
from touchline.operators.lineage import checkpointed

#: White space and words of the contracts, for Java and Python expressions alike.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"

#: Rows of two or three short columns: some tens of megabytes on an executor.
MAX_BROADCAST_ROWS = 500_000


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``df`` does not have, whatever columns it brings along."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def small_or_whole(df: DataFrame) -> DataFrame:
    """Broadcasts a stored table of short rows up to ``MAX_BROADCAST_ROWS``; a larger one is joined with a shuffle."""
    rows = df.limit(MAX_BROADCAST_ROWS + 1).count()
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def stored(df: DataFrame) -> DataFrame:
    """Writes a large table as Parquet into the shared folder and reads it back: a checkpoint that takes less room."""
    path = work_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def numbered(df: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, int]:
    """Adds gapless numbers from 0 in the given order, and tells how many rows there are.

    The rows are dealt by ranges, sorted and stored, so that a lost task cannot move a border; only one count for
    each partition passes through the driver. Rows that are equal in ``order`` may lie in several partitions.
    """
    tie, place, block, before = free_names(df, "tie", "place", "block", "before")
    spark = df.sparkSession
    rows = df.withColumn(tie, F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(*order, tie).sortWithinPartitions(*order, tie).drop(tie)
    stored = checkpointed(ranged.withColumn(place, F.monotonically_increasing_id()))
    within = (1 << 33) - 1
    counts = dict(stored.groupBy(F.shiftright(place, 33).alias(block)).count().collect())
    starts, total = [], 0
    for key in sorted(counts):
        starts.append((key, total))
        total += counts[key]
    offsets = spark.createDataFrame(starts, f"{block} long, {before} long")
    placed = stored.withColumn(block, F.shiftright(place, 33)).join(F.broadcast(offsets), block)
    number = F.col(before) + F.col(place).bitwiseAND(F.lit(within))
    return placed.withColumn(name, number).drop(block, before, place), total
