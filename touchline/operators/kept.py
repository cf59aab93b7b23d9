"""Tables kept for several uses within one piece of work."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame

_scope: ContextVar[list[DataFrame] | None] = ContextVar("kept_tables", default=None)


def keep(table: DataFrame) -> DataFrame:
    """Persists in memory, else on disk; a lost part is computed again."""
    kept = table.persist(StorageLevel.MEMORY_AND_DISK)
    scope = _scope.get()
    if scope is not None:
        scope.append(kept)
    return kept


@contextmanager
def released() -> Iterator[None]:
    """Gives up at its end what was kept inside, so a long stream does not pile tables up."""
    token = _scope.set([])
    try:
        yield
    finally:
        for table in _scope.get():
            table.unpersist()
        _scope.reset(token)
