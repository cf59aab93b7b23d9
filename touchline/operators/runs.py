"""Ordered operators over long keys: runs, running totals and previous values.

A window over a whole match puts all of its frames into one task, and one match may be a third
of the data. Here the order column is cut into blocks of fixed width. Each (key, block) is
worked on by itself, and a second, much smaller step joins what crosses the edges of the
blocks: at most two rows per key and block.

The order column is a whole number, unique within the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Some five minutes of play per block.
BLOCK = 8192


def block_of(order: str, width: int) -> Column:
    return F.floor(F.col(order) / width)


def consecutive_runs(
    rows: DataFrame, keys: list[str], order: str, partials: dict[str, Column], merges: dict[str, Column],
    width: int = BLOCK,
) -> DataFrame:
    """Maximal runs of consecutive order values within a key: one row per run.

    ``partials`` aggregate the rows of a piece of a run, ``merges`` the pieces of a run (over
    the partial columns). ``run_start`` and ``run_end`` are added. NULL keys form runs as well.
    """
    by_block = Window.partitionBy(*keys, "_block").orderBy(order)
    pieces = (
        rows.withColumn("_block", block_of(order, width))
        .withColumn("_piece", F.col(order) - F.row_number().over(by_block))
        .groupBy(*keys, "_block", "_piece")
        .agg(F.min(order).alias("run_start"), F.max(order).alias("run_end"), *_named(partials))
    )
    on_edge = (F.col("run_start") == F.col("_block") * width) | (F.col("run_end") == (F.col("_block") + 1) * width - 1)
    # Pieces inside a block are complete and keep to their own block; only edge pieces share a key.
    chain = F.when(~on_edge, F.col("_block"))
    ordered = Window.partitionBy(*keys, "_chain").orderBy("run_start")
    starts = F.coalesce(F.lag("run_end").over(ordered) + 1 != F.col("run_start"), F.lit(True))
    return (
        pieces.withColumn("_chain", chain)
        .withColumn("_starts", starts.cast("bigint"))
        .withColumn("_run", F.sum("_starts").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_chain", "_run")
        .agg(F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"), *_named(merges))
        .drop("_chain", "_run")
    )


def value_runs(
    rows: DataFrame, keys: list[str], order: str, value: str, partials: dict[str, Column],
    merges: dict[str, Column], width: int = BLOCK,
) -> DataFrame:
    """Maximal runs of rows with an equal ``value`` in the order of the key, across gaps in the order.

    The columns are those of ``consecutive_runs`` plus the value.
    """
    by_block = Window.partitionBy(*keys, "_block").orderBy(order)
    changed = ~F.col(value).eqNullSafe(F.lag(value).over(by_block)) | (F.row_number().over(by_block) == 1)
    pieces = (
        rows.withColumn("_block", block_of(order, width))
        .withColumn("_changed", changed.cast("bigint"))
        .withColumn("_piece", F.sum("_changed").over(by_block.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_block", "_piece", value)
        .agg(F.min(order).alias("run_start"), F.max(order).alias("run_end"), *_named(partials))
    )
    in_block = Window.partitionBy(*keys, "_block")
    on_edge = (F.col("_piece") == 1) | (F.col("_piece") == F.max("_piece").over(in_block))
    ordered = Window.partitionBy(*keys, "_chain").orderBy("run_start")
    # Two edge pieces of one block have other runs or another value between them.
    joins = F.col(value).eqNullSafe(F.lag(value).over(ordered)) & (F.lag("_block").over(ordered) < F.col("_block"))
    starts = ~F.coalesce(joins, F.lit(False))
    return (
        pieces.withColumn("_edge", on_edge)
        .withColumn("_chain", F.when(~F.col("_edge"), F.col("_block")))
        .withColumn("_starts", starts.cast("bigint"))
        .withColumn("_run", F.sum("_starts").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, value, "_chain", "_run")
        .agg(F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"), *_named(merges))
        .drop("_chain", "_run")
    )


def running_totals(
    rows: DataFrame, keys: list[str], order: str, totals: dict[str, Column], width: int = BLOCK
) -> DataFrame:
    """Adds inclusive running sums per key in the order of ``order``; NULL counts as nothing.

    ``rows`` are read once: the first row of each block carries the block's sums, these rows alone meet by key, and each block takes what
    came before it from its first row.
    """
    by_block = Window.partitionBy(*keys, "_block")
    local = by_block.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    first = F.row_number().over(by_block.orderBy(order)) == 1
    # Rows that begin no block stay with their block.
    blocks = Window.partitionBy(*keys, "_chain").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = {f"_sum_{n}": F.sum(value).over(by_block) for n, value in totals.items()}
    within = {f"_local_{n}": F.coalesce(F.sum(value).over(local), F.lit(0)) for n, value in totals.items()}
    summed = rows.withColumn("_block", block_of(order, width)).withColumns({**sums, **within, "_first": first})
    chained = summed.withColumn("_chain", F.when(~F.col("_first"), F.col("_block")))
    before = chained.withColumns({f"_before_{n}": F.when(F.col("_first"), F.sum(f"_sum_{n}").over(blocks)) for n in totals})
    return before.select(
        *rows.columns,
        *[(F.col(f"_local_{n}") + F.coalesce(F.max(f"_before_{n}").over(by_block), F.lit(0))).alias(n) for n in totals],
    )


def previous_values(
    rows: DataFrame, keys: list[str], order: str, values: dict[str, str], max_gap: int | None = None,
    width: int = BLOCK,
) -> DataFrame:
    """Adds each row's previous value per key (``new name -> column``).

    Beyond a jump of more than ``max_gap`` in the order the previous values are NULL. ``rows`` are read once: the first row of each
    block carries the block's last values, and these rows alone meet by key.
    """
    kept = F.struct(F.col(order).alias("_at"), *[F.col(c).alias(n) for n, c in values.items()])
    by_block = Window.partitionBy(*keys, "_block").orderBy(order)
    whole = by_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inside = rows.withColumn("_block", block_of(order, width)).withColumns(
        {"_previous": F.lag(kept).over(by_block), "_last": F.last(kept).over(whole), "_first": F.row_number().over(by_block) == 1}
    )
    blocks = Window.partitionBy(*keys, "_chain").orderBy("_block")
    chained = inside.withColumn("_chain", F.when(~F.col("_first"), F.col("_block")))
    previous = chained.withColumn("_previous", F.when(F.col("_first"), F.lag("_last").over(blocks)).otherwise(F.col("_previous")))
    usable = F.col("_previous").isNotNull()
    if max_gap is not None:
        usable = usable & (F.col(order) - F.col("_previous._at") <= max_gap)
    return previous.select(
        *rows.columns, *[F.when(usable, F.col(f"_previous.{name}")).alias(name) for name in values]
    )


def _named(aggregates: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in aggregates.items()]
