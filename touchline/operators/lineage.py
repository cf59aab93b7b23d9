"""Cutting long plans at a reliable copy."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """Copy in the cluster's checkpoint folder, which outlives any executor.

    The folder is the session's ``spark.checkpoint.dir``; a machine-local one is made only
    for a local session that names none.
    """
    _shared(df)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The same as Parquet, which takes less room: for large tables."""
    path = f"{_shared(df)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _shared(df: DataFrame) -> str:
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="touchline-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()
