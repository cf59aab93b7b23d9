"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.lineage import checkpointed

#: Edges of a task in a round, and edges that a task contracts together.
PER_TASK = 200_000


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of an edge; the component is its smallest node.

    Each task first replaces its edges by one from every node to the smallest it reaches over them. Rounds of large stars (every neighbour above a node is
    tied to the smallest neighbour) and small stars (every one below) then bring all nodes of a component to its minimum in a logarithmic number of rounds.
    Each is a grouping of edges with map-side minima, so a hub costs one row per task; the table is stored after each round, and the rounds end when it no
    longer changes, or when its edges are few enough for one task, ``PER_TASK``: then the contraction has seen them all.
    """
    now = checkpointed(edges.toDF("a", "b").where("a <> b").distinct())
    mark, rows = None, now.count()
    while True:
        tasks = max(1, -(-rows // PER_TASK))
        now = checkpointed(_contracted(now.coalesce(tasks), PER_TASK))
        if tasks == 1:
            break
        now = checkpointed(_star(_star(now, True, tasks), False, tasks))
        after = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        rows = after[0]
        if after == mark:
            break
        mark = after
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return ends.unionByName(roots).distinct()


def reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges ``a, b``, in order, and the smallest node that each reaches over them."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    low, x, y = np.arange(len(nodes)), place[: len(a)], place[len(a) :]
    while len(x):
        # Both ends are roots here; each is hung below the smallest root next to it, and all nodes below their root.
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(low, low[low]):
            low = low[low]
        x, y = low[x], low[y]
        x, y = x[x != y], y[x != y]
    return nodes, nodes[low]


def _contracted(edges: DataFrame, most: int) -> DataFrame:
    """Edges that connect the same nodes: of a task's edges, taken up some ``most`` at once, one from each node to the smallest it reaches."""
    schema = edges.schema

    def forest(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = pa.Table.from_batches(batches)
        nodes, low = reached(ends.column("a").to_numpy(), ends.column("b").to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(nodes[nodes != low]), pa.array(low[nodes != low])], ["a", "b"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held, rows = [*held, batch], rows + batch.num_rows
            if rows > most:
                yield forest(held)
                held, rows = [], 0
        if held:
            yield forest(held)

    return edges.mapInArrow(task, schema)


def _star(edges: DataFrame, large: bool, tasks: int) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        # Only the neighbours below a node, itself the largest.
        both = both.where("b < a")
    lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")).coalesce(tasks)
    tied = both.join(lowest, "a").coalesce(tasks)
    if large:
        made = tied.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        made = tied.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(lowest.select("a", F.col("low").alias("b")))
    return made.where("a <> b").distinct().coalesce(tasks)
