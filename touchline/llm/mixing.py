"""Mixing sources to target weights by repetition rates.

A document's size is its number of words (a null text has 0). Sources are weighed 3, 1, 2, 3, 1, ... in code point order, null
last, and share ``SHARE`` of all sizes. A target stops at ``MOST`` times its source's size; what is left over is shared again by
weight among the others until none is above. A source's rate is target / size (0 where it has no words); each of
its documents is taken floor(rate) times, plus once more with the probability of the fraction. The draw is a hash of
the seed and ``doc_id``, so reruns agree and repeated rows draw alike; a null ``doc_id`` draws as one id of its own. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.rows import WORDS, free_names, numbered, small_or_whole
from touchline.operators.lineage import checkpointed

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix-1"
_DRAW_BITS = 52


def words_of(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def draw(doc_id: F.Column, seed: str = SEED) -> F.Column:
    """Uniform number in [0, 1) from the first 52 bits of a hash."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, _DRAW_BITS // 4), 16, 10).cast("double") / F.lit(float(2**_DRAW_BITS))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from rows of ``source`` and ``size``.

    Sizes are summed on the map side first, so a hot source costs one row per task. Sources are ranked by a distributed sort, and
    the level to which unfilled sources are poured is found from sums of the source table alone: each pass closes
    every source that would overflow, until none does.
    """
    summed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked, _ = numbered(summed, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = checkpointed(ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * most))
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, closed = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= F.col("most")
        held, weight_left, now = sources.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight"))),
            F.sum(full.cast("int")),
        ).first()
        if now == closed or not weight_left:
            break
        level, closed = (budget - held) / weight_left, now
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(level))
    return sources.select("source", "source_size", target.alias("target"))


def mixed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """All rows and columns of ``docs`` with ``size, source_size, target, copies``, under free names in this order."""
    size, source_size, target, copies, key = free_names(docs, "size", "source_size", "target", "copies", "mixed_source")
    sized = docs.withColumn(size, words_of("text"))
    targets = source_targets(sized.select("source", F.col(size).alias("size")))
    other = small_or_whole(checkpointed(targets.toDF(key, source_size, target)))
    joined = sized.join(other, sized["source"].eqNullSafe(other[key])).drop(key)
    rate = F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)).otherwise(0.0)
    times = F.floor(rate) + (draw(F.col("doc_id"), seed) < rate - F.floor(rate)).cast("long")
    return joined.withColumn(copies, times)


def emitted(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``."""
    copies = free_names(docs, "size", "source_size", "target", "copies")[3]
    rows = mixed(docs, seed).where(F.col(copies) > 0)
    again = F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))
    return rows.select(*docs.columns, again.alias(copies)).drop(copies)
