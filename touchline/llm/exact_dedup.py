"""Exact duplicates: frequent digests are removed on the map side, the others after an ordinary shuffle.

Texts are equal when they are identical after each run of ``[\\x20\\x09-\\x0D]`` became one space; a null text counts
as empty, and equality is that of the SHA-256 digest of the normalised text. Of equal texts the row with the
smallest ``doc_id`` stays; a null ``doc_id`` comes last, and of repeated rows one stays. An empty table gives an empty
result. Other columns of the input are not looked at.

Misra-Gries summaries of at most ``COUNTERS`` digests are made by each task and merged, so every digest with more
than one in ``COUNTERS`` of all rows is among the candidates. Their exact counts and winners are then computed with
map-side partial sums and broadcast (at most ``COUNTERS`` rows). Rows of a verified digest never reach the shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.rows import SPACES, free_names, small_or_whole
from touchline.operators.lineage import checkpointed

COUNTERS = 1000


def digest(text: str) -> F.Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    normal = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " ")
    return F.unhex(F.sha2(normal, 256))


def summaries(batches: Iterator[pd.DataFrame], counters: int) -> Iterator[pd.DataFrame]:
    """Misra-Gries counters of one task: what is left of ``digest`` counts after each overflow is paid off."""
    held: Counter = Counter()
    for batch in batches:
        held.update(batch["digest"])
        held = reduced(held, counters)
    yield pd.DataFrame({"digest": list(held), "seen": list(held.values())})


def reduced(held: Counter, counters: int) -> Counter:
    """At most ``counters`` counters: the next largest count is taken off all of them."""
    if len(held) <= counters:
        return held
    due = held.most_common(counters + 1)[-1][1]
    return Counter({key: count - due for key, count in held.items() if count > due})


def frequent(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digests that may be frequent: the merged summaries of all tasks, at most ``counters`` rows."""
    parts = rows.select("digest").mapInPandas(lambda b: summaries(b, counters), "digest binary, seen long")
    largest = parts.groupBy("digest").agg(F.sum("seen").alias("seen")).orderBy(F.desc("seen"), "digest").limit(counters + 1)
    held = Counter({bytes(row["digest"]): row["seen"] for row in largest.collect()})
    found = [(key, count) for key, count in reduced(held, counters).items()]
    return rows.sparkSession.createDataFrame(found, "digest binary, seen long").select("digest")


def winners(rows: DataFrame) -> DataFrame:
    """For each digest the row that stays (nulls last, then the stored order) and the number of rows."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "place"))
    found = rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size"))
    return found.select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.place").alias("keep_place"), "group_size")


def groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per input row: ``doc_id, digest, keep_id, group_size, kept``."""
    named = docs.select("doc_id", digest("text").alias("digest"))
    rows = checkpointed(named.withColumn("place", F.monotonically_increasing_id()))
    heavy = checkpointed(winners(rows.join(F.broadcast(frequent(rows, counters)), "digest", "left_semi")))
    answered = rows.join(F.broadcast(heavy), "digest")
    rest = rows.join(F.broadcast(heavy), "digest", "left_anti")
    whole = answered.unionByName(rest.join(winners(rest), "digest"))
    return whole.select("doc_id", "digest", "keep_id", "group_size", (F.col("place") == F.col("keep_place")).alias("kept"))


def deduplicated(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows that stay, with all their columns.

    Only ids and digests are shuffled; the texts meet the list of rows to drop in a join that broadcasts the list while
    it is small. Rows repeated with the same id and text are thinned to one among themselves.
    """
    key = free_names(docs, "digest")[0]
    found = checkpointed(groups(docs, counters))
    same = found.groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"), F.count("*").alias("times"))
    known = checkpointed(same.where(~F.col("kept") | (F.col("times") > 1)))
    marked = docs.withColumn(key, digest("text"))
    lookup = known.select(F.col("doc_id").alias("known_id"), F.col("digest").alias("known_digest"), "kept")

    def matching(kind: str, part: DataFrame) -> DataFrame:
        other = small_or_whole(part)
        return marked.join(other, marked["doc_id"].eqNullSafe(other["known_id"]) & (marked[key] == other["known_digest"]), kind)

    single = matching("left_anti", lookup)
    repeated = matching("left_semi", lookup.where("kept")).dropDuplicates(["doc_id", key])
    return single.unionByName(repeated).select(*docs.columns)
