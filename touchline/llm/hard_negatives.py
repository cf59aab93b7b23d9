"""Hard negatives among vectors, mined through STR-packed R-trees.

Rows ``vec_id, label, vector, anchor``: the marked rows are anchors. A row's score is its inner product with the anchor; higher scores come first, ties by smaller
``vec_id``. An anchor's positives are its first ``POSITIVES`` other rows of the same label (all, if fewer). For each of them the hard negatives are the first
``NEGATIVES`` rows of other labels whose score lies between 50 % and 95 % of the positive's.

Trees. Rows are range-partitioned by length, label, first component and a hash of the id, about ``TREE`` in a partition, so ties and hot labels are split like
everything else. Each partition is packed by sort-tile-recursive: sorted by label, then tiled by the ``TILES`` components of largest spread into leaves of at most
``LEAF`` rows; the index is a stored table. A node's minimum bounding box bounds an anchor's scores in it from both sides, component by
component, and the labels in it.

Search. A task holds one tree; anchors visit it in blocks. A queue takes the node with the best upper bound first. A node is dropped for an anchor if no
window of its scores meets the node's interval, if the upper bound lies strictly below the kth score that the anchor has (ties must still be seen), or if its
labels are all wrong. Anchors search their own tree first; with the kth scores found there, blocks are sent to those other trees whose boxes
they cannot drop. The results of the trees are merged by rank. Blocks against trees are pairs of stored boxes, not of rows; random vectors of many dimensions
have boxes that drop little, and then each block visits every tree, the plain product of anchors and rows in blocks.

Rows without an id or a label, and vectors that are null or hold null or non-finite components, take no part; rows of other lengths than the anchor's neither.
Repeats of a row are one row; rows of one id with different labels or vectors are rows of their own, and none of them is a positive of an anchor with that id.
Labels are whole numbers. Scores are sums in double precision: exact for whole numbers up to 2**53, and cut to 64 bits where they are larger. Tables
without anchors, and empty ones, give an empty result; other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.rows import stored
from touchline.llm.streams import dealt, matrix, stretches
from touchline.operators.lineage import checkpointed

POSITIVES, NEGATIVES = 5, 3
#: A negative's score in per cent of the positive's.
LOW, HIGH = 50, 95
#: Rows of a tree and of a leaf, children of a node, components that are tiled, anchors of a block.
TREE, LEAF, FAN, TILES, BLOCK = 8192, 64, 16, 3, 256


def packed(labels: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by sort-tile-recursive, and the number of each one's leaf."""
    spread = np.argsort(vectors.min(axis=0, initial=np.inf) - vectors.max(axis=0, initial=-np.inf), kind="stable")[:TILES]
    tiles = [np.arange(len(labels))]
    if len(labels):
        order = np.argsort(labels, kind="stable")
        bounds = np.flatnonzero(np.diff(labels[order])) + 1
        # Labels are tiles of their own unless they are too many to fill leaves.
        tiles = np.split(order, bounds) if (len(bounds) + 1) * leaf <= len(labels) else [order]
    for depth, axis in enumerate(spread.tolist()):
        cut = []
        for tile in tiles:
            leaves = -(-len(tile) // leaf)
            slices = max(1, round(leaves ** (1 / (TILES - depth))))
            size = max(1, -(-leaves // slices)) * leaf
            sorted_tile = tile[np.argsort(vectors[tile, axis], kind="stable")]
            cut += [sorted_tile[low : low + size] for low in range(0, len(tile), size)]
        tiles = cut
    tiles = [tile[low : low + leaf] for tile in tiles for low in range(0, len(tile), leaf)]
    order = np.concatenate([*tiles, np.empty(0, np.int64)]).astype(np.int64)
    return order, np.repeat(np.arange(len(tiles)), [len(t) for t in tiles])


def _indexed(rows: DataFrame, tree: int) -> DataFrame:
    """``tree, dim, leaf, vec_id, label, vector, anchor`` in packed order; a partition is a tree for each length of vectors."""
    first = F.element_at("vector", 1)
    keys = [F.size("vector"), F.col("label"), first, F.xxhash64("vec_id")]
    trees = max(1, -(-rows.count() // tree))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        sizes = whole.column("dim").to_numpy()
        for dim in np.unique(sizes).tolist():
            part = whole.filter(pa.array(sizes == dim)).combine_chunks()
            vectors = np.asarray(part.column("vector").combine_chunks().flatten()).reshape(-1, dim)
            order, leaf = packed(part.column("label").to_numpy(), vectors)
            part = part.take(pa.array(order))
            made = pa.array([v.tobytes() for v in np.ascontiguousarray(vectors[order])], pa.binary())
            same = [pa.array(np.full(len(order), v), pa.int32()) for v in (number, dim)]
            columns = [*same, pa.array(leaf, pa.int32()), part.column("vec_id"), part.column("label"), made, part.column("anchor")]
            yield from pa.Table.from_arrays(columns, ["tree", "dim", "leaf", "vec_id", "label", "vector", "anchor"]).combine_chunks().to_batches()

    ranged = rows.withColumn("dim", F.size("vector")).repartitionByRange(trees, *keys).select("vec_id", "label", "vector", "anchor", "dim")
    return stored(ranged.mapInArrow(task, "tree int, dim int, leaf int, vec_id long, label long, vector binary, anchor boolean"))


class Tree:
    """Rows of one tree in packed order, and the boxes of its nodes by level, leaves first."""

    def __init__(self, leaf: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.lexsort([ids, leaf])
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.starts = np.flatnonzero(np.diff(leaf[order], prepend=-1))
        self.stops = np.append(self.starts[1:], len(order))
        levels = [self._over(self.vectors, self.vectors, self.labels, self.labels, self.starts)]
        while len(levels[-1][0]) > 1:
            levels.append(self._over(*levels[-1], np.arange(0, len(levels[-1][0]), FAN)))
        self.levels = levels

    @staticmethod
    def _over(low, high, first, last, starts):
        return tuple(f.reduceat(v, starts, axis=0) for f, v in ((np.minimum, low), (np.maximum, high), (np.minimum, first), (np.maximum, last)))

    def search(self, block: "Block", k: int, same: bool) -> "Block":
        """Lets the anchors of a block take their ``k`` best rows for each of their windows, of their own label or of others."""
        up, down = np.maximum(block.vectors, 0), np.minimum(block.vectors, 0)
        bounds = []
        for low, high, first, last in self.levels:
            label = block.labels[:, None]
            fits = (first <= label) & (label <= last) if same else (first != label) | (last != label)
            bounds.append((up @ high.T + down @ low.T, up @ low.T + down @ high.T, fits))

        def active(level: int, node: int) -> np.ndarray:
            upper, lower, fits = (b[:, node] for b in bounds[level])
            open_window = (upper[:, None] >= block.least) & (lower[:, None] <= block.high)
            return np.flatnonzero(fits & open_window.any(axis=1))

        queue: list[tuple[float, int, int]] = []

        def push(level: int, nodes: range) -> None:
            for node in nodes:
                rows = active(level, node)
                if len(rows):
                    heapq.heappush(queue, (-float(bounds[level][0][rows, node].max()), level, node))

        push(len(self.levels) - 1, range(1))
        while queue:
            _, level, node = heapq.heappop(queue)
            if level:
                push(level - 1, range(node * FAN, min((node + 1) * FAN, len(self.levels[level - 1][0]))))
                continue
            rows = active(0, node)
            if len(rows):
                part = slice(self.starts[node], self.stops[node])
                own = self.labels[part] == block.labels[rows, None]
                allowed = own & (self.ids[part] != block.ids[rows, None]) if same else ~own
                block.take(rows, block.vectors[rows] @ self.vectors[part].T, self.ids[part], allowed, k)
        return block


class Block:
    """Some anchors with their windows, and for each window the best rows so far and the least score that may still enter."""

    def __init__(self, ids, labels, vectors, low, high, least, k: int):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.high, self.least = high, np.maximum(low, least)
        self.scores = np.full((*low.shape, k), -np.inf)
        self.found = np.zeros((*low.shape, k), dtype=np.int64)

    def take(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> None:
        for window in range(self.high.shape[1]):
            fits = allowed & (scores >= self.least[rows, window][:, None]) & (scores <= self.high[rows, window][:, None])
            some = np.flatnonzero(fits.any(axis=1))
            if not len(some):
                continue
            at = rows[some]
            both = np.concatenate([self.scores[at, window], np.where(fits[some], scores[some], -np.inf)], axis=1)
            names = np.concatenate([self.found[at, window], np.broadcast_to(ids, (len(some), len(ids)))], axis=1)
            order = np.lexsort([names, -both], axis=1)[:, :k]
            self.scores[at, window] = np.take_along_axis(both, order, axis=1)
            self.found[at, window] = np.take_along_axis(names, order, axis=1)
            self.least[at, window] = np.maximum(self.least[at, window], self.scores[at, window, k - 1])


def _padded(lists: pa.Array, value: float) -> np.ndarray:
    width = max(1, max(map(len, lists), default=1))
    return np.array([v + [value] * (width - len(v)) for v in lists.to_pylist()], dtype=np.float64).reshape(len(lists), width)


def _visited(index: DataFrame, visitors: DataFrame, k: int, same: bool) -> DataFrame:
    """``anchor, window, vec_id, score``: of each tree the best rows for its visitors."""
    none = {"number": "long", "low": "array<double>", "high": "array<double>", "least": "array<double>"}
    keys = ["tree", "dim"]
    residents = index.select(*keys, F.lit(0).alias("role"), "leaf", "vec_id", "label", "vector", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    guests = visitors.select(*keys, F.lit(1).alias("role"), F.col("block").alias("leaf"), "vec_id", "label", "vector", *none)
    schema = pa.schema([("anchor", pa.int64()), ("window", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parts, tree = None, [], None
        for (*key, role), part in stretches(batches, [*keys, "role"]):
            if key != known:
                known, parts, tree = key, [], None
            for low in range(0, part.num_rows, BLOCK):
                some = part.slice(low, BLOCK)
                rows = [some.column(c).to_numpy() for c in ("leaf", "vec_id", "label")] + [matrix(some.column("vector"))]
                if role == 0:
                    parts.append(rows)
                    continue
                if not parts:
                    continue
                tree = tree or Tree(*(np.concatenate(c) for c in zip(*parts, strict=True)))
                windows = [_padded(some.column(c), v) for c, v in (("low", np.inf), ("high", -np.inf), ("least", np.inf))]
                block = tree.search(Block(*rows[1:], *windows, k), k, same)
                anchor, window, place = np.nonzero(block.scores > -np.inf)
                columns = [some.column("number").to_numpy()[anchor], window.astype(np.int32), block.found[anchor, window, place], block.scores[anchor, window, place]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    rows = dealt(residents.unionByName(guests), keys, ["role", "leaf", "vec_id"])
    return rows.mapInArrow(task, "anchor long, window int, vec_id long, score double")


def _boxes(index: DataFrame) -> DataFrame:
    """``tree, dim, low, high, first, last``: boxes over the stored stretches of each tree, of vectors and labels."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, dim), part in stretches(batches, ["tree", "dim"]):
            vectors, labels = matrix(part.column("vector")), part.column("label").to_numpy()
            values = [tree, dim, vectors.min(axis=0).tobytes(), vectors.max(axis=0).tobytes(), labels.min(), labels.max()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

    names, kinds = ["tree", "dim", "low", "high", "first", "last"], [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return index.select("tree", "dim", "label", "vector").mapInArrow(task, "tree int, dim int, low binary, high binary, first long, last long")


def _block_box(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack([np.frombuffer(v) for v in rows["vector"]])
    least = min((max(a, b) for low, floor in zip(rows["low"], rows["least"], strict=True) for a, b in zip(low, floor, strict=True)), default=np.inf)
    high = max((v for values in rows["high"] for v in values), default=-np.inf)
    ends = [vectors.min(axis=0).tobytes(), vectors.max(axis=0).tobytes(), rows["label"].min(), rows["label"].max(), least, high]
    return pd.DataFrame([[*key, *ends]], columns=["home", "dim", "block", "a_low", "a_high", "a_first", "a_last", "least", "most"])


def _elsewhere(visitors: DataFrame, boxes: DataFrame, same: bool) -> DataFrame:
    """The visitors with each other tree that their block cannot drop."""
    blocks = checkpointed(visitors.groupBy("home", "dim", "block").applyInPandas(
        _block_box, "home int, dim int, block int, a_low binary, a_high binary, a_first long, a_last long, least double, most double"
    ))
    fits = "first <= a_last and a_first <= last" if same else "not (first = last and a_first = a_last and first = a_first)"
    # A stated set of queries in blocks against boxes of trees; both sides are one row for hundreds or thousands of rows.
    met = blocks.crossJoin(boxes.withColumnRenamed("dim", "box_dim")).where(f"dim = box_dim and home <> tree and {fits}").drop("box_dim")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_,), part in stretches(batches, ["dim"]):
            one, two, low, high = (matrix(part.column(c)) for c in ("a_low", "a_high", "low", "high"))
            corners = np.stack([one * low, one * high, two * low, two * high])
            reach = corners.max(axis=0).sum(axis=1) >= part.column("least").to_numpy()
            reach &= corners.min(axis=0).sum(axis=1) <= part.column("most").to_numpy()
            yield part.select(["home", "dim", "block", "tree"]).filter(pa.array(reach))

    pairs = met.mapInArrow(task, "home int, dim int, block int, tree int").distinct()
    return visitors.drop("tree").join(pairs, ["home", "dim", "block"])


def _best(index: DataFrame, boxes: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """``anchor, window, vec_id, score, place``: the first ``k`` rows for each window of the anchors."""
    none = F.transform("low", lambda _: F.lit(float("-inf")))
    near = checkpointed(_visited(index, anchors.withColumns({"tree": F.col("home"), "least": none}), k, same))
    kth = near.groupBy("anchor", "window").agg(F.count("*").alias("n"), F.min("score").alias("score")).where(F.col("n") >= k)
    kth = kth.groupBy(F.col("anchor").alias("number")).agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("kth"))
    known = anchors.join(kth, "number", "left")
    floor = F.transform(F.col("low"), lambda _, i: F.coalesce(F.col("kth")[i], F.lit(float("-inf"))))
    far = _visited(index, _elsewhere(checkpointed(known.withColumn("least", floor).drop("kth")), boxes, same), k, same)
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return near.unionByName(far).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mined(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, tree: int = TREE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for rows ``vec_id, label, vector, anchor``."""
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vector = F.transform(F.col("vector").cast("array<double>"), lambda x: x + 0.0).alias("vector")
    whole = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), vector, F.coalesce("anchor", F.lit(False)).alias("anchor"))
    index = _indexed(checkpointed(whole.where(sound).distinct()), tree)
    boxes = checkpointed(_boxes(index))
    place = F.row_number().over(Window.partitionBy("tree", "dim").orderBy("leaf", "vec_id")) - 1
    anchors = index.where("anchor").withColumn("block", F.floor(place / BLOCK).cast("int")).withColumnRenamed("tree", "home")
    anchors = stored(anchors.select("home", "dim", "block", "vec_id", "label", "vector", F.monotonically_increasing_id().alias("number")))
    whole_line = {"low": F.array(F.lit(float("-inf"))), "high": F.array(F.lit(float("inf")))}
    first = checkpointed(_best(index, boxes, anchors.withColumns(whole_line), positives, same=True))
    ranked = F.sort_array(F.collect_list(F.struct("place", "vec_id", "score")))
    shares = first.groupBy(F.col("anchor").alias("number")).agg(ranked.alias("positives"))
    windows = anchors.join(shares, "number").withColumns({
        "low": F.transform("positives", lambda p: F.ceil(LOW * p["score"] / 100).cast("double")),
        "high": F.transform("positives", lambda p: F.floor(HIGH * p["score"] / 100).cast("double")),
    })
    windows = checkpointed(windows)
    hard = _best(index, boxes, windows.drop("positives"), negatives, same=False)
    chosen = windows.select(F.col("number").alias("anchor"), F.col("vec_id").alias("anchor_id"), "positives")
    named = hard.join(chosen, "anchor").withColumn("positive", F.get("positives", F.col("window")))
    return named.select(
        "anchor_id", F.col("positive.vec_id").alias("positive_id"), F.col("place").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("positive.score").cast("long").alias("positive_score"), F.col("score").cast("long").alias("negative_score"),
    )


def relabelled(vectors: DataFrame) -> DataFrame:
    """The rows of the contract: components as ``floor(256 * x)``, every seventh id with the next label, every fiftieth an anchor."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda x: F.when(~F.isnan(x) & (F.abs(x) < float("inf")), F.floor(256 * x.cast("double")).cast("double")))
    return vectors.select("vec_id", label.alias("label"), vector.alias("vector"), (F.col("vec_id") % 50 == 0).alias("anchor"))
