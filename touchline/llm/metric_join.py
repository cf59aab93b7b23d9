"""Near duplicates among vectors: an exact metric range join with pivots.

Two vectors link when their labels are equal and not null, their lengths are equal, and their cosine, in double precision, is at least ``COSINE``.
On unit vectors that is a distance of at most ``r = sqrt(2 - 2 * COSINE)``. Cosines within ``CLOSE`` of the bound are decided by exact
fractions of the stored numbers.

Cells. Equal vectors of a label are one node first. Of each label a random sample of about ``sqrt(nodes) / PER_PIVOT`` nodes, chosen by hash, are
its pivots; every node lives in the cell of its nearest pivot. By the triangle inequality a partner of ``x`` that lives with another pivot lies at
most ``r`` from ``x`` and on the other side of the plane between both pivots, so ``x`` is sent as a guest only to cells whose plane is at most ``r`` away; of
two cells one sends its guests to the other. Cells are joined independently.

Slabs. The nodes that live in a cell are dealt by hash into slabs of about ``SLAB``. A task holds one slab and compares what visits it, guests
and half of the cell's other slabs, batch by batch in matrix products: a cell that holds most rows is spread over as many tasks as
it has slabs. A slab returns one row for each node with its number of links, and for each visitor one linked node; nodes of the slab that a
visitor connects are tied to one of them. So no pair becomes a row, and every link is counted.

Result, one row per input row: ``vec_id, n_links, component_id, kept``. Vectors that are null, empty, zero or hold null or non-finite
components, and those without a label, link with nothing and are components of their own. Rows repeated with id, label and vector are one
vector, each reported; other rows of a known id are vectors of their own. A null ``vec_id`` takes part; its component is the smallest id in
reach, or null if there is none. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.components import components
from touchline.llm.rows import small_or_whole, stored
from touchline.llm.streams import dealt, matrix, stretches
from touchline.operators.lineage import checkpointed

COSINE = 0.93
PER_PIVOT = 16
#: Nodes whose pivots are sought together, nodes of a slab, and visitors that are compared at once.
CHUNK, SLAB, VISITORS = 8192, 1024, 1024
CLOSE = 1e-12
#: Room for rounding in bounds on distances.
SLACK = 1e-9


def _raw(values: pa.Array) -> bytes | None:
    """The numbers of a vector that can link."""
    if values is None or not len(values) or values.null_count:
        return None
    numbers = values.to_numpy() + 0.0
    return numbers.tobytes() if np.isfinite(numbers).all() and numbers.any() else None


def _read(vectors: DataFrame, wide: bool) -> DataFrame:
    """``vec_id, digest`` of each row, and with ``wide`` its group (label and length) and numbers; a vector that cannot link has no digest."""
    kind, id_kind = dict(vectors.dtypes)["embedding"], dict(vectors.dtypes)["vec_id"]
    single = kind == "array<float>"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for label, vector in zip(batch.column("label").to_pylist(), batch.column("embedding"), strict=True):
                raw = None if label is None else _raw(vector.values)
                group = None if raw is None else f"{len(raw)}:{label}"
                made.append((None if raw is None else blake2b(raw, digest_size=16, key=blake2b(group.encode()).digest()).digest(), group, raw))
            digests, groups, raws = zip(*made, strict=True) if made else ((), (), ())
            columns = [batch.column("vec_id"), pa.array(digests, pa.binary())]
            if wide:
                columns += [pa.array(groups, pa.string()), pa.array(raws, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "digest", "grp", "vector"][: len(columns)])

    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast(kind if single else "array<double>"))
    return rows.mapInArrow(task, f"vec_id {id_kind}, digest binary" + (", grp string, vector binary" if wide else ""))


def _units(column: pa.Array, single: bool) -> np.ndarray:
    numbers = matrix(column, np.float32 if single else np.float64).astype(np.float64)
    numbers = numbers / np.abs(numbers).max(axis=1, keepdims=True, initial=0)
    return numbers / np.sqrt((numbers * numbers).sum(axis=1, keepdims=True))


def reach(cosine: float) -> float:
    return math.sqrt(2 - 2 * cosine) + SLACK


def cells_of(units: np.ndarray, pivots: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each vector, and which other cells may hold partners of it."""
    near = units @ pivots.T
    home = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
    # Twice the distance to the plane between two pivots, times the distance of the pivots.
    over = near[np.arange(len(units)), home][:, None] - near
    guest = over <= reach(cosine) * apart[home] + SLACK
    guest[np.arange(len(units)), home] = False
    return home, guest


def _homes(nodes: DataFrame, pivots: DataFrame, cosine: float, single: bool) -> DataFrame:
    """``node, grp, copies, vector, home, guests``: the cell of each node and those it is sent to."""
    keys = ["grp", "chunk"]
    rows = pivots.select(*keys, F.lit(0).alias("role"), "node", F.lit(None).cast("long").alias("copies"), "vector")
    rows = dealt(rows.unionByName(nodes.select(*keys, F.lit(1).alias("role"), "node", "copies", "vector")), keys, ["role", "node"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = None, np.empty((0, 0))
        for (grp, chunk, role), part in stretches(batches, [*keys, "role"]):
            units = _units(part.column("vector"), single)
            if (grp, chunk) != known:
                known, held = (grp, chunk), units[:0]
            if role == 0:
                held = np.concatenate([held, units])
                continue
            home, guests = np.zeros(len(units), dtype=np.int32), [[]] * len(units)
            if len(held):
                home, guest = cells_of(units, held, cosine)
                # Of two cells, the larger number sends to the smaller if both are odd or even together, else the other way round.
                other = np.arange(len(held))
                sends = (other < home[:, None]) == ((other + home[:, None]) % 2 == 0)
                guests = [np.flatnonzero(g).astype(np.int32) for g in guest & sends]
            columns = [*(part.column(c) for c in ("node", "grp", "copies", "vector")), pa.array(home, pa.int32()), pa.array(guests, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "grp", "copies", "vector", "home", "guests"])

    return rows.mapInArrow(task, "node long, grp string, copies long, vector binary, home int, guests array<int>")


class Slab:
    """The nodes of one slab, their links so far, and which of them are tied together."""

    def __init__(self, nodes: np.ndarray, copies: np.ndarray, raw: np.ndarray, units: np.ndarray, cosine: float):
        self.nodes, self.copies, self.raw, self.units, self.cosine = nodes, copies, raw, units, cosine
        self.label = np.arange(len(nodes))
        self.links = np.zeros(len(nodes), dtype=np.int64)
        link = self._linked(raw, units)
        np.fill_diagonal(link, True)
        self._tie(link)
        self.links += link @ copies - copies

    def _linked(self, raw: np.ndarray, units: np.ndarray) -> np.ndarray:
        near = units @ self.units.T
        link = near >= self.cosine
        bound = Fraction(str(self.cosine))
        for i, j in np.argwhere(np.abs(near - self.cosine) < CLOSE).tolist():
            x, y = ([Fraction(float(v)) for v in vector] for vector in (raw[i], self.raw[j]))
            both, xx, yy = (sum(a * b for a, b in zip(p, q, strict=True)) for p, q in ((x, y), (x, x), (y, y)))
            link[i, j] = both * both >= bound * bound * xx * yy
        return link

    def _tie(self, link: np.ndarray) -> None:
        """Nodes of the slab that share a visitor get one label."""
        used = np.flatnonzero(link.any(axis=1))
        some = link[used]
        low = np.where(some, self.label, len(self.label)).min(axis=1, initial=len(self.label))
        high = np.where(some, self.label, -1).max(axis=1, initial=-1)
        for row in np.flatnonzero(low < high).tolist():
            labels = np.unique(self.label[some[row]])
            if len(labels) > 1:
                self.label[np.isin(self.label, labels)] = labels[0]

    def visited(self, nodes: np.ndarray, copies: np.ndarray, raw: np.ndarray, units: np.ndarray) -> pa.RecordBatch:
        link = self._linked(raw, units)
        self.links += copies @ link
        self._tie(link)
        found = np.flatnonzero(link.any(axis=1))
        return _link_rows(nodes[found], self.nodes[link[found].argmax(axis=1)], link[found] @ self.copies)

    def rows(self) -> pa.RecordBatch:
        """The slab's own links and ties; a node with none is left out."""
        found = np.flatnonzero(self.links)
        return _link_rows(self.nodes[found], self.nodes[self.label[found]], self.links[found])


def _link_rows(node: np.ndarray, other: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (node, other, links)], ["node", "other", "links"])


def _met(rows: DataFrame, cosine: float, single: bool) -> DataFrame:
    """``node, other, links``: of each slab the links it saw and connections that span what it linked."""
    keys = ["grp", "cell", "slab"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parts, slab = None, [], None

        def begun() -> Slab:
            return Slab(*(np.concatenate(c) for c in zip(*parts, strict=True)), cosine)

        for (*key, role), part in stretches(batches, [*keys, "role"]):
            if key != known:
                if parts:
                    yield (slab or begun()).rows()
                known, parts, slab = key, [], None
            for low in range(0, part.num_rows, VISITORS):
                some = part.slice(low, VISITORS)
                raw = matrix(some.column("vector"), np.float32 if single else np.float64)
                block = (some.column("node").to_numpy(), some.column("copies").to_numpy(), raw, _units(some.column("vector"), single))
                if role == 0:
                    parts.append(block)
                elif parts:
                    slab = slab or begun()
                    yield slab.visited(*block)
        if parts:
            yield (slab or begun()).rows()

    return dealt(rows, keys, ["role", "node"]).mapInArrow(task, "node long, other long, links long")


def _slab_rows(homes: DataFrame, slab_size: int) -> DataFrame:
    """``grp, cell, slab, role, node, copies, vector``: each node in its slab, and as a visitor of others."""
    cells = homes.groupBy("grp", F.col("home").alias("cell")).agg(F.count("*").alias("n"))
    cells = small_or_whole(checkpointed(cells.select("grp", "cell", F.ceil(F.col("n") / slab_size).cast("int").alias("slabs"))))
    own = homes.withColumnRenamed("home", "cell").join(cells, ["grp", "cell"]).withColumn("own", F.pmod(F.xxhash64("node"), "slabs").cast("int"))
    # Of two slabs the later one visits if their numbers differ by an odd number, else the earlier.
    others = F.filter(F.sequence(F.lit(0), F.col("slabs") - 1), lambda t: (t != F.col("own")) & ((t < F.col("own")) == ((t + F.col("own")) % 2 == 1)))
    base = ["grp", "cell", "slab", "role", "node", "copies", "vector"]
    residents = own.withColumns({"slab": F.col("own"), "role": F.lit(0)}).select(*base)
    inside = own.withColumns({"slab": F.explode(others)}).withColumn("role", F.lit(1)).select(*base)
    guests = homes.withColumn("cell", F.explode("guests")).join(cells, ["grp", "cell"])
    guests = guests.withColumn("slab", F.explode(F.sequence(F.lit(0), F.col("slabs") - 1))).withColumn("role", F.lit(1)).select(*base)
    return residents.unionByName(inside).unionByName(guests)


def near_vectors(vectors: DataFrame, cosine: float = COSINE, per_pivot: int = PER_PIVOT, slab: int = SLAB, chunk: int = CHUNK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row."""
    single = dict(vectors.dtypes)["embedding"] == "array<float>"
    members = _read(vectors, wide=False)
    copies = members.where("digest is not null").distinct().groupBy("digest").agg(F.count("*").alias("copies"), F.min("vec_id").alias("lowest"))
    distinct = _read(vectors, wide=True).where("digest is not null").drop("vec_id").dropDuplicates(["digest"])
    nodes = stored(distinct.join(copies, "digest").withColumn("node", F.monotonically_increasing_id()))
    sizes = nodes.groupBy("grp").agg(F.count("*").alias("n")).withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int"))
    wanted = F.ceil(F.sqrt("n") / per_pivot)
    sizes = small_or_whole(checkpointed(sizes.withColumn("rate", F.when(wanted > 1, wanted / F.col("n")).otherwise(0.0))))
    named = nodes.join(sizes, "grp").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    pivots = named.where(_uniform("digest") < F.col("rate")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    homes = stored(_homes(named, pivots, cosine, single))
    links = checkpointed(_met(_slab_rows(homes, slab), cosine, single))
    found = components(links.select("node", "other"))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    whole = nodes.select("digest", "node", "copies", "lowest").join(counted, "node", "left").join(found, "node", "left")
    whole = checkpointed(whole.withColumn("component", F.coalesce("component", "node")))
    lowest = whole.groupBy("component").agg(F.min("lowest").alias("component_id"))
    placed = whole.join(lowest, "component").select("digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    rows = members.join(small_or_whole(checkpointed(placed)), "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    rows = rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _uniform(digest: str) -> Column:
    """A number in [0, 1) that the digest fixes."""
    return F.pmod(F.xxhash64(F.lit(7), digest), F.lit(1 << 40)) / F.lit(float(1 << 40))
