"""Joins of tracking rows with small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.kept import keep

# 500k rows of ids are some tens of megabytes on each executor.
MAX_BROADCAST_ROWS = 500_000


def bounded(table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Computes a derived lookup table once and broadcasts it only if it is small.

    Spark cannot know the size of a derived table when it plans, and would otherwise shuffle
    all tracking rows by match. The table is kept (memory, else disk) so that counting it does
    not compute it twice. A larger one is returned without a hint: a shuffled join, in which
    adaptive execution splits the partitions of hot matches.
    """
    kept = keep(table)
    rows = kept.limit(max_rows + 1).count()
    return F.broadcast(kept) if rows <= max_rows else kept


def attach(rows: DataFrame, table: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join that keeps the column order of ``rows`` and appends the other columns."""
    added = [c for c in table.columns if c not in on]
    return rows.join(table, on, how).select(*rows.columns, *added)
