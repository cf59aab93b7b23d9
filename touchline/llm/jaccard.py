"""N-gram Jaccard join by PartEnum signatures, and the groups its links make.

A document's set holds the 64-bit hashes of its distinct 5-word shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; with fewer words
the whole sequence is one). Two documents link when ``100 * intersection >= 80 * union``; no set, no link.

Signatures. Two linked sets of sizes ``x <= y`` differ in at most ``(x + y) / 9 <= x / 4`` elements. Sets are dealt into bands of
sizes; a set takes part in its own band and, if a partner may be larger than the band's end, in the next. Each band partitions the hash domain into
equal ranges (first level), and each range into three parts (second level). Of a range two of the three parts are signed, in all three ways: sets that differ in
a range by one element share the way that leaves its part out. Parts that hold less than two elements in all are signed together with the third
part, whole and without each of its elements, so no signature stands for less than two elements.
In order of the ranges a set signs those with two elements or more, until their weight (2 for three elements or more, else 1) exceeds ``x // 4``. A range of weight
``w`` is lost to a partner only by ``w`` differing elements: so a linked pair shares a range, and at least
``(x // 4 + 1 - (x + y) // 9) / 2`` signatures. A set whose ranges do not reach that weight also signs all its elements one by one; two such sets share most of these.

Work. Texts equal up to white space are one node first. Signatures are shuffled once; only those that several nodes share go on.
Each bucket has a centre, its node with the largest buckets in all, which in a group of near copies is the text they stem from. (1) A node and
the centre it shares most with are verified if they share many, and components are formed: this joins a large group by as many pairs as it has nodes.
(2) Nodes that share some signatures with their centre form families with it. The nodes of a family in different components are compared in blocks by
bitmaps of ``BITS`` bits, into which each set hashes its elements: sets differ in at least as many elements as their bitmaps in bits. Only pairs that this bound
and their sizes allow become rows. (3) Buckets whose members are of different families
give the pairs whose sizes fit (a bucket of more than ``CROWDED`` nodes like a family, in blocks of bitmaps); a pair that shares as many signatures as a linked pair must, and passes the bound of the bitmaps, goes on. Pairs
of (2) and (3) are verified by whole sets, exactly.

Rows without words have size 0 and are components of their own. A null ``doc_id`` takes part; its component is the smallest id in reach, or
null if there is none. Repeated rows are one node. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.components import components
from touchline.llm.exact_dedup import digest
from touchline.llm.rows import free_names, numbered, small_or_whole, stored
from touchline.llm.words import Words, in_chunks, mixed, windows
from touchline.operators.lineage import checkpointed

SHINGLE = 5
#: Links need intersection * 5 >= union * 4.
BAND_GROWTH = 1.5625
#: Nodes of a block in verification.
BLOCK = 128
#: Bits of a set's bitmap, and nodes whose bitmaps are compared together.
BITS, WIDE = 2048, 1024
#: Elements looked at together when a block is verified.
ELEMENTS = 8192
#: Share of a node's signatures that makes a pair worth a look in the first pass; it decides no link.
LIKELY = 0.45
#: Share of its signatures that a pair needs to be of one family.
FAMILY = 0.1
#: Nodes of a bucket from which on it is compared by bitmaps in blocks, so that its pairs are no rows.
CROWDED = 32
_SHORT = mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def bands(size: int) -> list[int]:
    """Ends of the size bands up to the one after that of ``size``."""
    ends = [4]
    while ends[-1] < size or len(ends) < 2 or ends[-2] < size:
        ends.append(int(ends[-1] * BAND_GROWTH))
    return ends


def ranges_of(end: int) -> int:
    """Number of ranges of the hash domain in a band: some six elements each, and a margin for small sets."""
    return max(1, end // 7 + round(0.35 * end**0.5) + (end > 6) - (end > 60))


def shingles(words: Words) -> list[np.ndarray]:
    """The sorted set of each document."""
    hashes = words.hashes(lower=True)
    long = windows(hashes, SHINGLE)
    sets = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            sets.append(np.unique(long[a : b - SHINGLE + 1]))
        elif b > a:
            sets.append(mixed(windows(hashes[a:b], b - a) + _SHORT[b - a - 1]))
        else:
            sets.append(np.empty(0, dtype=np.uint64))
    return sets


def may_differ(size):
    """In how many elements a set differs at most from a linked one that is not smaller."""
    return size // 4


def signed(size: F.Column) -> F.Column:
    """About how many signatures a set has in a band."""
    return size * 0.4 + 2


def least_shared(small: F.Column, large: F.Column) -> F.Column:
    """How many signatures of a band linked sets share at least."""
    return F.ceil((F.floor(small / 4) + 1 - F.floor((small + large) / 9)) / 2)


_THREE = np.uint64(3)
_RANGE, _LONE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x165667B19E3779F9)
_PARTS = mixed(np.arange(101, 104, dtype=np.uint64))


def _sums(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=values.dtype)
    np.cumsum(values, out=total[1:])
    return total[stops] - total[starts]


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """PartEnum signatures of sorted sets, in all bands they take part in: the signatures and the number of the set of each, in order."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    ends = np.array(bands(int(size.max(initial=1))), dtype=np.int64)
    band = np.searchsorted(ends, size)
    whole = np.arange(len(sets))
    second = (size * 5 > ends[band] * 4 - 5) & (size > 0)
    # A set in a band takes part; its elements are looked at once for each.
    part_set = np.concatenate([whole[size > 0], whole[second]])
    part_band = np.concatenate([band[size > 0], band[second] + 1])
    first = np.append(0, np.cumsum(size))
    taken = size[part_set]
    begin = np.cumsum(taken) - taken
    part = np.repeat(np.arange(len(taken)), taken)
    elements = np.concatenate([*sets, np.empty(0, np.uint64)])[np.arange(len(part)) - begin[part] + first[part_set[part]]]
    count = np.array([ranges_of(int(e)) for e in ends], dtype=np.uint64)
    # The top 32 bits choose the range, and the rest of that product the third of it.
    scaled = (elements >> np.uint64(32)) * count[part_band[part]]
    held, third = (scaled >> np.uint64(32)).astype(np.int64), ((scaled & np.uint64(0xFFFFFFFF)) * _THREE >> np.uint64(32)).astype(np.int64)
    opens = np.ones(len(part), dtype=bool)
    opens[1:] = (part[1:] != part[:-1]) | (held[1:] != held[:-1])
    starts = np.flatnonzero(opens)
    stops = np.append(starts[1:], len(part))
    owner, m = part[starts], stops - starts
    weight = np.where(m >= 3, 2, m == 2)
    before = np.cumsum(weight) - weight
    before -= before[np.searchsorted(owner, owner)]
    need = may_differ(size[part_set])
    signs = (m >= 2) & (before <= need[owner])
    reached = np.bincount(owner, weights=weight, minlength=len(taken)) > need
    value = mixed(elements)
    salt = mixed(part_band.astype(np.uint64))[owner] + (held[starts] + 1).astype(np.uint64) * _RANGE
    total = _sums(value, starts, stops)
    made, of = [], []
    for out in range(3):
        inside = third == out
        lone = _sums(np.where(inside, value, np.uint64(0)), starts, stops)
        left = m - _sums(inside.astype(np.int64), starts, stops)
        base = total - lone + salt + _PARTS[out]
        plain = np.flatnonzero(signs & (left >= 2))
        poor = np.flatnonzero(signs & (left < 2))
        made += [base[plain], (base + _LONE + lone * _LONE)[poor]]
        of += [owner[plain], owner[poor]]
        poor = poor[m[poor] >= 3]
        each = np.repeat(poor, m[poor])
        place = np.arange(len(each)) - np.repeat(np.cumsum(m[poor]) - m[poor], m[poor]) + starts[each]
        each, place = each[inside[place]], place[inside[place]]
        made.append(base[each] + _LONE + (lone[each] - value[place]) * _LONE)
        of.append(owner[each])
    single = np.flatnonzero(~reached[part])
    made.append(value[single] + mixed(part_band[part[single]].astype(np.uint64) + np.uint64(1 << 20)))
    of.append(part[single])
    made, of = np.concatenate(made), np.concatenate(of)
    # The last bit tells the two bands of a set apart.
    made = mixed(made) & ~np.uint64(1) | (part_band[of] % 2).astype(np.uint64)
    order = np.argsort(part_set[of], kind="stable")
    return made[order], part_set[of][order]


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``BITS`` bits for each set."""
    owner = np.repeat(np.arange(len(sets)), [len(found) for found in sets])
    place = (mixed(np.concatenate([*sets, np.empty(0, np.uint64)])) % np.uint64(BITS)).astype(np.int64)
    bits = np.zeros((len(sets), BITS), dtype=bool)
    bits[owner, place] = True
    return np.packbits(bits, axis=1)


def possible(one: np.ndarray, other: np.ndarray, size: np.ndarray, other_size: np.ndarray) -> np.ndarray:
    """Which of all pairs of two blocks of bitmaps and sizes may link."""
    x, y = (np.unpackbits(b, axis=1).astype(np.float32) for b in (one, other))
    differ = x.sum(axis=1)[:, None] + y.sum(axis=1) - 2 * (x @ y.T)
    both = size[:, None] + other_size
    return (9 * differ <= both) & (5 * np.minimum(size[:, None], other_size) >= 4 * np.maximum(size[:, None], other_size))


def _node() -> F.Column:
    """A document by its id and text."""
    return F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit("")))


def nodes_of(docs: DataFrame) -> DataFrame:
    """``doc_id, node, rep``: texts equal up to white space have one representative node."""
    rows = checkpointed(docs.select("doc_id", _node().alias("node"), digest("text").alias("digest")))
    first = rows.groupBy("digest").agg(F.min("node").alias("rep"))
    return checkpointed(rows.join(first, "digest").select("doc_id", "node", "rep"))


def _signed(texts: DataFrame) -> DataFrame:
    """``signature, node, size, bits``; size and bitmap stand in the first row of each node, the others have 0 and none. A node without words has one row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            for words in in_chunks(batch.column("text")):
                sets = shingles(words)
                made, of = signatures(sets)
                empty = np.flatnonzero([not len(found) for found in sets])
                of = np.concatenate([of, empty])
                order = np.argsort(of, kind="stable")
                made, of = np.concatenate([made, np.zeros(len(empty), np.uint64)])[order], of[order]
                size, first = np.zeros(len(of), dtype=np.int32), np.searchsorted(of, np.arange(len(sets)))
                size[first] = [len(found) for found in sets]
                maps = np.full(len(of), -1, dtype=np.int32)
                maps[first] = np.arange(len(sets))
                bits = pa.array([b.tobytes() for b in bitmaps(sets)], pa.binary()).take(pa.array(maps, mask=maps < 0))
                columns = [made.view(np.int64), nodes[words.rows][of], size]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), bits], ["signature", "node", "size", "bits"])

    return texts.mapInArrow(task, "signature long, node long, size int, bits binary")


def _sets(texts: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and the ``found`` set of each text as bytes."""
    fields = dict(texts.dtypes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in in_chunks(batch.column("text")):
                found = pa.array([s.tobytes() for s in shingles(words)], pa.binary())
                part = batch.slice(words.rows.start, words.rows.stop - words.rows.start)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), found], [*keep, "found"])

    return texts.mapInArrow(task, ", ".join(f"{c} {fields[c]}" for c in keep) + ", found binary")


def _shared(found: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``rows`` with the sets ``columns``: products of 0/1 matrices, some elements at a time."""
    elements, owner = np.concatenate(found), np.repeat(np.arange(len(found)), [len(f) for f in found])
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], owner[order]
    number = np.cumsum(np.concatenate([[False], elements[1:] != elements[:-1]]))
    common = np.bincount(number)[number] > 1
    number, owner = np.unique(number[common], return_inverse=True)[1], owner[common]
    both = np.zeros((len(rows), len(columns)), dtype=np.int64)
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, ELEMENTS):
        part = slice(*np.searchsorted(number, [start, start + ELEMENTS]))
        has = np.zeros((len(found), ELEMENTS), dtype=np.float32)
        has[owner[part], number[part] - start] = 1
        both += (has[rows] @ has[columns].T).astype(np.int64)
    return both


def _checked(sets: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """The pairs of one block of a family that link."""
    found = [np.frombuffer(value, np.uint64) for value in sets["found"]]
    if not found or pairs.empty:
        return pairs[["a", "b"]].iloc[:0]
    places = pd.Series(np.arange(len(found)), index=sets["node"])
    places = places[~places.index.duplicated()]
    rows, row = np.unique(places[pairs["a"]].to_numpy(), return_inverse=True)
    columns, column = np.unique(places[pairs["b"]].to_numpy(), return_inverse=True)
    both = _shared(found, rows, columns)[row, column]
    size = np.array([len(f) for f in found])
    union = size[rows][row] + size[columns][column] - both
    return pairs.loc[100 * both >= 80 * union, ["a", "b"]]


def verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of nodes that link; pairs of one ``kin`` are likely to share nodes.

    The nodes of all pairs, ordered by their kin, are cut into blocks of ``BLOCK`` nodes, and
    each set travels once to every pair of blocks in which it is needed. So a task holds two blocks of sets at most, and a set goes to few tasks.
    """
    ends = pairs.select("kin", F.explode(F.array("a", "b")).alias("node"))
    placed = ends.groupBy("node").agg(F.min("kin").alias("component"))
    counted, _ = numbered(placed, [F.col("component"), F.col("node")], "number")
    blocks = small_or_whole(checkpointed(counted.select("node", F.floor(F.col("number") / BLOCK).alias("block"))))
    sides = pairs.select("a", "b")
    for side in "ab":
        named = blocks.select(F.col("node").alias(side), F.col("block").alias(f"{side}_block"))
        sides = sides.join(named, side)
    keyed = checkpointed(sides.select(F.least("a_block", "b_block").alias("i"), F.greatest("a_block", "b_block").alias("j"), "a", "b"))
    ends = keyed.select("i", "j", F.explode(F.array("a", "b")).alias("needed")).distinct()
    needed = small_or_whole(checkpointed(ends))
    wanted = texts.join(needed, F.col("node") == F.col("needed")).select("i", "j", "node", "text")
    key = ["i", "j"]
    sets = _sets(wanted, [*key, "node"])
    return sets.groupBy(key).cogroup(keyed.groupBy(key)).applyInPandas(_checked, "a long, b long")


def _allowed(part: pd.DataFrame) -> pd.DataFrame:
    """Of two blocks of a family, each one row, the pairs ``a, b`` in different components that may link; their kin is the family."""
    blocks = []
    for side in "ij":
        block = part.loc[part["block"] == part[side], "nodes"].iloc[0]
        node, component, size = (np.array([n[c] for n in block], dtype=np.int64) for c in ("node", "component", "size"))
        blocks.append((node, component, size, np.stack([np.frombuffer(n["bits"], np.uint8) for n in block])))
    (a, p, x, one), (b, q, y, other) = blocks
    fits = possible(one, other, x, y) & (p[:, None] != q)
    if (part["i"] == part["j"]).iloc[0]:
        fits = np.triu(fits, 1)
    row, column = np.nonzero(fits)
    return pd.DataFrame({"a": a[row], "b": b[column], "kin": part["family"].iloc[0]})


def inside(placed: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs ``a, b, kin`` within families that may link nodes of different components, for rows ``node, family, component, size``.

    The nodes of a family, ordered by component and size, are cut into blocks of ``WIDE``. A block is one row of bitmaps; two blocks are compared in one
    task, unless they hold a single component or no sizes that fit.
    """
    counted, _ = numbered(placed, [F.col(c) for c in ("family", "component", "size", "node")], "number")
    # Stored, since both its starts and its blocks are read from it.
    counted = checkpointed(counted)
    starts = counted.groupBy("family").agg(F.min("number").alias("start"))
    cut = counted.join(starts, "family").withColumn("block", F.floor((F.col("number") - F.col("start")) / WIDE))
    cut = checkpointed(cut.select("node", "family", "component", "block", "size"))
    piece = cut.groupBy("family", "block").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("size").alias("small"), F.max("size").alias("large")
    )
    left, right = (piece.select("family", *[F.col(c).alias(f"{side}_{c}") for c in piece.columns[1:]]) for side in "ij")
    single = (F.least("i_low", "j_low") == F.greatest("i_high", "j_high"))
    fit = (F.col("j_large") * 5 >= F.col("i_small") * 4) & (F.col("i_large") * 5 >= F.col("j_small") * 4)
    blocks = left.join(right, "family").where((F.col("i_block") <= F.col("j_block")) & ~single & fit)
    met = blocks.select("family", F.col("i_block").alias("i"), F.col("j_block").alias("j"))
    met = checkpointed(met.withColumn("block", F.explode(F.array_distinct(F.array("i", "j")))))
    used = cut.join(met.select("family", "block").distinct(), ["family", "block"]).join(bits, "node")
    packed = used.groupBy("family", "block").agg(F.collect_list(F.struct("node", "component", "size", "bits")).alias("nodes"))
    # Few rows, but much work for each: adaptive execution must not merge them into few tasks.
    tasks = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = packed.join(met, ["family", "block"]).repartition(tasks, "family", "i", "j")
    return dealt.groupBy("family", "i", "j").applyInPandas(_allowed, "a long, b long, kin long")


def links(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of nodes with their texts: ``node, size``, and verified links ``a, b`` that connect whatever links connect."""
    bucket = Window.partitionBy("signature")
    rows = _signed(texts).withColumn("members", F.count("*").over(bucket))
    held = stored(rows.where("members > 1 or size > 0 or signature = 0"))
    weight = F.sum(F.when(F.col("members") > 1, F.col("members")).otherwise(0))
    sizes = held.groupBy("node").agg(F.max("size").alias("size"), weight.alias("weight"))
    sizes = checkpointed(sizes.withColumn("place", F.monotonically_increasing_id()))
    bits = held.where("size > 0").select("node", "bits")
    buckets = held.where("signature <> 0 and members > 1").select("signature", "node")
    weighed = buckets.join(small_or_whole(sizes.select("node", "weight")), "node")
    central = weighed.withColumn("centre", F.max(F.struct("weight", "node")).over(bucket)["node"])
    stars = central.where("node <> centre").groupBy("node", "centre").agg(F.count("*").alias("shared"))
    best = stars.groupBy("node").agg(F.max(F.struct("shared", "centre")).alias("best"))
    best = checkpointed(best.join(sizes, "node").select("node", "best", "size"))
    family = checkpointed(components(best.where(F.col("best.shared") >= FAMILY * signed(F.col("size"))).select("node", "best.centre")))
    likely = best.where(F.col("best.shared") >= LIKELY * signed(F.col("size")))
    first = checkpointed(verified(texts, checkpointed(likely.select(F.col("best.centre").alias("a"), F.col("node").alias("b"), F.col("best.centre").alias("kin")))))
    kin = family.withColumnRenamed("component", "family")
    held_by = kin.join(components(first), "node", "left").join(sizes.select("node", "size"), "node")
    near = inside(held_by.withColumn("component", F.coalesce("component", "node")), bits)
    # Whatever the first pass linked is of one family.
    named_by = sizes.join(kin, "node", "left").select("node", "place", "size", F.coalesce("family", "node").alias("family"))
    placed = buckets.join(small_or_whole(checkpointed(named_by)), "node")
    spread = {"low": F.min("family").over(bucket), "high": F.max("family").over(bucket), "members": F.count("*").over(bucket)}
    split = stored(placed.withColumns(spread).where("low < high").drop("low", "high"))
    # Stored, since numbering reads it several times.
    near = near.unionByName(inside(checkpointed(_crowded(split)), bits))
    split = split.where(F.col("members") <= CROWDED)
    left, right = (split.select("signature", *[F.col(c).alias(f"{side}_{c}") for c in ("place", "family", "size")]) for side in "ab")
    fit = (F.col("a_family") < F.col("b_family")) & (5 * F.least("a_size", "b_size") >= 4 * F.greatest("a_size", "b_size"))
    across = left.join(right, "signature").where(fit).groupBy("a_place", "b_place")
    odd = F.col("signature").bitwiseAND(F.lit(1))
    ends = [F.max(f"{side}_size").alias(f"{side}_size") for side in "ab"]
    across = across.agg(F.greatest(F.sum(odd), F.sum(1 - odd)).alias("shared"), *ends)
    across = across.where(F.col("shared") >= least_shared(F.least("a_size", "b_size"), F.greatest("a_size", "b_size")))
    named = small_or_whole(sizes.select("place", "node"))
    for side in "ab":
        across = across.join(named.toDF(f"{side}_place", side), f"{side}_place")
    for side in "ab":
        across = across.join(bits.toDF(side, f"{side}_bits"), side)
    second = verified(texts, checkpointed(near.unionByName(_unlike(across)).groupBy("a", "b").agg(F.min("kin").alias("kin"))))
    return sizes.select("node", "size"), checkpointed(first.unionByName(second))


def _crowded(split: DataFrame) -> DataFrame:
    """Buckets of more than ``CROWDED`` nodes as families for ``inside``; of buckets with the same nodes, as a passage makes them, one."""
    hot = split.where(F.col("members") > CROWDED)
    same = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"print{seed}") for seed in (1, 2)]
    prints = hot.groupBy("signature").agg(F.count("*").alias("nodes"), *same)
    chosen = prints.groupBy("nodes", "print1", "print2").agg(F.min("signature").alias("signature")).select("signature")
    # A bucket's nodes differ in their families only.
    return hot.join(small_or_whole(checkpointed(chosen)), "signature").select("node", F.col("signature").alias("bucket"), "family", "size").withColumnsRenamed(
        {"family": "component", "bucket": "family"}
    )


def _unlike(pairs: DataFrame) -> DataFrame:
    """``a, b, kin`` of the pairs whose bitmaps allow a link."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("a_bits", "b_bits"))
            differ = np.unpackbits(x ^ y, axis=1).sum(axis=1, dtype=np.int64)
            passes = pa.array(9 * differ <= batch.column("a_size").to_numpy() + batch.column("b_size").to_numpy())
            yield batch.select(["a", "b"]).filter(passes)

    return pairs.mapInArrow(task, "a long, b long").withColumn("kin", F.least("a", "b"))


def grouped(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, node, component_node`` (the last two name the text, not the id)."""
    nodes = nodes_of(docs)
    dropped = nodes.where("node <> rep").select(F.col("node").alias("copy")).distinct()
    copies = small_or_whole(checkpointed(dropped))
    texts = docs.select(_node().alias("node"), "text").join(copies, F.col("node") == F.col("copy"), "left_anti")
    sizes, edges = links(texts)
    found = components(edges)
    placed = nodes.join(found, nodes["rep"] == found["node"], "left").drop(found["node"])
    placed = placed.select("doc_id", nodes["node"], "rep", F.coalesce("component", "rep").alias("component_node"))
    placed = checkpointed(placed.join(sizes.withColumnRenamed("node", "rep"), "rep"))
    # Texts without words are equal to each other, but linked with nothing.
    key = F.when(F.col("size") > 0, F.col("component_node"))
    named = placed.groupBy(key.alias("named")).agg(F.min("doc_id").alias("lowest"))
    whole = placed.join(named, key == F.col("named"), "left")
    component = F.when(F.col("size") > 0, F.col("lowest")).otherwise(F.col("doc_id"))
    return whole.select("doc_id", F.col("size").cast("long").alias("n_shingles"), component.alias("component_id"), "node", "component_node")


def representatives(docs: DataFrame) -> DataFrame:
    """The rows that stay when each group keeps its row of the smallest ``doc_id``, with all columns; texts without words all stay."""
    node, gone = free_names(docs, "node", "gone")
    found = checkpointed(grouped(docs))
    first = found.where("n_shingles > 0").groupBy("component_node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")).alias("first")
    )
    kept = first.select("component_node", F.col("first.node").alias("stays"))
    drop = found.where("n_shingles > 0").join(kept, "component_node").where("node <> stays").select(F.col("node").alias(gone)).distinct()
    rows = docs.withColumn(node, _node())
    other = small_or_whole(checkpointed(drop))
    left = rows.join(other, rows[node] == other[gone], "left_anti")
    return left.select(*docs.columns)
