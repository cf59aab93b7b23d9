"""Rows of one key in the order of frames, in bounded memory.

A state's worker gets the rows of its key in pieces and in any order. Up to ``held`` of them stay in memory; beyond that they go to sorted runs in the task's
scratch folder, as in Spark's own sort, and the runs are merged by slices. A slice has whole frames: about ``size`` rows, or one frame that has more.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

BY = "frame_id"
#: Rows in memory before a run is written, of a slice, and of a run's part that is read at once; runs that are merged at once.
HELD, SLICE, PART, FAN = 1 << 17, 1 << 15, 1 << 12, 64
_KINDS = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}


def _scratch() -> str | None:
    """Folder of the executor's blocks, which Spark names to its workers and deletes with the executor."""
    folders = [path for path in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if os.path.isdir(path)]
    return folders[os.getpid() % len(folders)] if folders else None


def _in_order(rows: pa.Table) -> pa.Table:
    return rows.take(np.argsort(rows[BY].to_numpy(), kind="stable")).combine_chunks()


class _Run:
    """Rows in order; those of a file are read part by part."""

    def __init__(self, rows: pa.Table, path: str | None = None):
        self.rows, self.next = rows, 0
        self.file = pa.ipc.open_file(pa.OSFile(path)) if path else None

    def frames(self) -> np.ndarray:
        return self.rows[BY].to_numpy()

    def grow(self) -> bool:
        """Reads one more part, if there is one."""
        if self.file is None or self.next == self.file.num_record_batches:
            return False
        self.rows = pa.concat_tables([self.rows, pa.Table.from_batches([self.file.get_batch(self.next)])])
        self.next += 1
        return True

    def take(self, end: int | None) -> pa.Table:
        """Rows of frames before ``end``, which are no longer of the run."""
        count = len(self.rows) if end is None else int(np.searchsorted(self.frames(), end))
        taken, self.rows = self.rows.slice(0, count), self.rows.slice(count)
        return taken


class SortedRows:
    """Takes rows piece by piece and gives them back in slices. Closing it removes its files."""

    def __init__(self, fields: dict[str, str], held: int = HELD, size: int = SLICE, fan: int = FAN):
        self.schema = pa.schema([(name, _KINDS[kind]) for name, kind in fields.items()])
        self.held, self.size, self.fan = held, size, fan
        self.pieces: list[pa.Table] = []
        self.levels: list[list[str]] = [[]]  # runs by the number of merges behind them
        self.folder: tempfile.TemporaryDirectory | None = None
        self.count, self.written, self.newest = 0, 0, None

    def __enter__(self) -> SortedRows:
        return self

    def __exit__(self, *_) -> None:
        self.pieces, self.levels = [], [[]]
        if self.folder is not None:
            self.folder.cleanup()

    def add(self, rows: pd.DataFrame) -> None:
        if not len(rows):
            return
        newest = int(rows[BY].max())
        self.newest = newest if self.newest is None else max(self.newest, newest)
        self.pieces.append(pa.Table.from_pandas(rows, schema=self.schema, preserve_index=False))
        self.count += len(rows)
        if self.count >= self.held:
            self._keep(0, iter([self._in_memory()]))

    def slices(self) -> Iterator[pd.DataFrame]:
        """All rows, once."""
        runs = [_Run(self.schema.empty_table(), path) for level in self.levels for path in level]
        if self.count:
            runs.append(_Run(self._in_memory()))
        for rows in self._merged(runs):
            yield rows.to_pandas()

    def _in_memory(self) -> pa.Table:
        rows = _in_order(pa.concat_tables(self.pieces))
        self.pieces, self.count = [], 0
        return rows

    def _keep(self, level: int, tables: Iterator[pa.Table]) -> None:
        """Writes a run; as many as can be merged at once become one of the next level."""
        if self.folder is None:
            self.folder = tempfile.TemporaryDirectory(prefix="touchline-rows-", dir=_scratch())
        path = f"{self.folder.name}/{self.written}"
        self.written += 1
        with pa.OSFile(path, "wb") as out, pa.ipc.new_file(out, self.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
            for rows in tables:
                writer.write_table(rows, max_chunksize=PART)
        self.levels[level].append(path)
        if len(self.levels[level]) == self.fan:
            paths, self.levels[level] = self.levels[level], []
            self.levels += [[]] if level + 1 == len(self.levels) else []
            self._keep(level + 1, self._merged([_Run(self.schema.empty_table(), one) for one in paths]))
            for one in paths:
                os.remove(one)

    def _merged(self, runs: list[_Run]) -> Iterator[pa.Table]:
        while runs:
            share = max(1, self.size // len(runs))
            for run in runs:
                while len(run.rows) <= share and run.grow():
                    pass
            runs = [run for run in runs if run.rows]
            if not runs:
                return
            # Every run has its rows before this frame in memory, and no more than its share of them.
            end = min((int(run.frames()[share]) for run in runs if len(run.rows) > share), default=None)
            first = min(int(run.frames()[0]) for run in runs)
            if end == first:
                end = first + 1
                for run in runs:
                    while run.frames()[-1] == first and run.grow():
                        pass
            yield _in_order(pa.concat_tables([run.take(end) for run in runs]))
