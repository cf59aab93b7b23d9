"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered by ``doc_id`` (nulls first), then checksum and size, so equal rows are interchangeable. The number goes
through a Feistel network over the rectangle ``width * height >= rows``; a result beyond the last row is permuted
again until it falls inside (cycle walking). Position ``p`` lies in shard ``p % shards`` at slot ``p // shards``: row counts differ by one
at most (law ``rows``), slots are gapless, and both can be computed for a row, or the row for them, without any data.
Null and empty texts have size 8 and checksum 0. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.rows import numbered

SHARDS = 24
SEED = 2024
ROUNDS = 8


def _mixed(values: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves about half of the output's."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64(key)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> list[int]:
    steps = np.arange(1, ROUNDS + 1, dtype=np.uint64)
    return [int(k) for k in _mixed(steps, seed * 0x9E3779B97F4A7C15 % 2**64)]


class Permutation:
    """A permutation of ``range(rows)`` fixed by ``rows`` and ``seed``."""

    def __init__(self, rows: int, seed: int = SEED):
        self.rows, self.keys = rows, _keys(seed)
        self.width = max(1, math.isqrt(max(rows - 1, 0)) + 1)
        self.height = max(1, -(-rows // self.width))

    def _once(self, values: np.ndarray) -> np.ndarray:
        left, right = np.divmod(values, self.height)
        for turn, key in enumerate(self.keys):
            if turn % 2:
                right = (right + (_mixed(left, key) % np.uint64(self.height)).astype(np.int64)) % self.height
            else:
                left = (left + (_mixed(right, key) % np.uint64(self.width)).astype(np.int64)) % self.width
        return left * self.height + right

    def _back(self, values: np.ndarray) -> np.ndarray:
        left, right = np.divmod(values, self.height)
        for turn, key in reversed(list(enumerate(self.keys))):
            if turn % 2:
                right = (right - (_mixed(left, key) % np.uint64(self.height)).astype(np.int64)) % self.height
            else:
                left = (left - (_mixed(right, key) % np.uint64(self.width)).astype(np.int64)) % self.width
        return left * self.height + right

    def _walk(self, step, values) -> np.ndarray:
        values = step(np.asarray(values, dtype=np.int64))
        while (outside := values >= self.rows).any():
            values[outside] = step(values[outside])
        return values

    def position(self, numbers) -> np.ndarray:
        """Where rows of these numbers go."""
        return self._walk(self._once, numbers)

    def number(self, positions) -> np.ndarray:
        """Numbers of the rows at these positions."""
        return self._walk(self._back, positions)


def row_at(shard: int, slot: int, rows: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """Number of the row in a slot of a shard."""
    return int(Permutation(rows, seed).number([slot * shards + shard])[0])


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number``."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    short = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows, total = numbered(short, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], "row_number")

    @F.pandas_udf("long")
    def position(numbers: pd.Series) -> pd.Series:
        return pd.Series(Permutation(total, seed).position(numbers))

    placed = rows.withColumn("position", position("row_number"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("position") % shards).cast("int").alias("shard"),
        F.expr(f"position div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )
