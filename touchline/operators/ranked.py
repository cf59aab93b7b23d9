"""The k-th smallest value of a group, without gathering the group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def kth_row(rows: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "_rank") -> DataFrame:
    """The row at 0-based position ``k`` of each group; groups with fewer rows give none.

    The rank limit is applied before the shuffle as well, so a group of any size sends at most
    ``k + 1`` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn(name, rank).filter(F.col(name) <= k + 1).filter(F.col(name) == k + 1).drop(name)
