"""Stored tables of the catalog, in a work folder of the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from touchline import schemas
from touchline.catalog.tracking_view import raw_tracking
from touchline.sources.files import stage_table
from touchline.sources.sinks import write_by_match

_STORED: dict[tuple[str, str], str] = {}


def work_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's shared one; a local session may use its own disk."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is not None:
        return f"{shared}/touchline-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    return tempfile.mkdtemp(prefix="touchline-")


def raw_table(spark: SparkSession, folder: str) -> DataFrame:
    """Raw tracking rows of a folder, written once per application by match and block of frames."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STORED:
        path = f"{work_folder(spark)}/raw_positions"
        write_by_match(raw_tracking(spark, folder), path)
        _STORED[key] = path
    return stage_table(spark, _STORED[key], schemas.RAW_POSITIONS)


def raw_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows for a query that reads them once: as they are stored, else from the view itself, which is not stored for it."""
    if (spark.sparkContext.applicationId, folder) in _STORED:
        return raw_table(spark, folder)
    return raw_tracking(spark, folder).select(*schemas.RAW_POSITIONS.names)
