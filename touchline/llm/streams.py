"""Rows that meet under a key, read as a stream: a bounded side is held, the other passes by in batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def dealt(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of a key in one partition, next to each other, in the given order."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order)


def stretches(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of the batches within which all keys are the same; a key may go on in the next slice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = np.zeros(batch.num_rows, dtype=bool)
        cut[0] = True
        for key in keys:
            number = batch.column(key).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            cut[1:] |= number[1:] != number[:-1]
        low = np.flatnonzero(cut)
        for a, b in zip(low.tolist(), np.append(low[1:], batch.num_rows).tolist(), strict=True):
            yield tuple(batch.column(key)[a].as_py() for key in keys), batch.slice(a, b - a)


def matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    """A binary column as rows of numbers; all rows have one length."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype=kind).reshape(len(column), -1)
