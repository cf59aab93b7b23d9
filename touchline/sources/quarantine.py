"""Sources that lose nothing: what can be read, and what cannot with its file, text and reason.

Every source reads its input as text first, so a rejected row still holds what came. Both sides are plain expressions over one scan and work on
batches and streams alike; each input row is in exactly one of them, so their counts add up to the input.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import schemas
from touchline.sources.files import _reader, named_override

REJECT_COLUMNS = ("source", "file", "text", "reason")
_CORRUPT = "_corrupt"
#: One document between its tags, or a tag without attributes that is closed at once.
_DOCUMENT = r"(?s)<MatchInformation[\s>].*?</MatchInformation\s*>"


class Split(NamedTuple):
    """``good`` rows in the shape of their source, ``rejects`` in that of ``REJECT_COLUMNS``."""

    good: DataFrame
    rejects: DataFrame


def _split(rows: DataFrame, source: str, reason: Column, *columns: str | Column) -> Split:
    """``rows`` hold ``file`` and ``text``; a NULL ``reason`` lets a row pass."""
    marked = rows.withColumn("_reason", reason)
    rejects = marked.filter(F.col("_reason").isNotNull()).select(F.lit(source).alias("source"), "file", "text", F.col("_reason").alias("reason"))
    return Split(marked.filter(F.col("_reason").isNull()).select(*columns), rejects)


def _as_json(rows: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """``text`` under one struct column; its ``_corrupt`` field holds text that does not fit the schema."""
    whole = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return rows.withColumn(name, F.from_json("text", whole, options))


def _unreadable(name: str) -> Column:
    return F.col(name).isNull() | F.col(f"{name}.{_CORRUPT}").isNotNull()


def text_lines(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None, whole: bool = False) -> DataFrame:
    """``file, text``: the lines of text files, or whole files."""
    lines = _reader(spark, streaming, max_files).text(path, wholetext=whole)
    return lines.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))


def time_major(lines: DataFrame) -> Split:
    """Lines of frame records: ``n, frames``. Empty lines are no records."""
    parsed = _as_json(lines.filter(F.trim("text") != ""), schemas.TIME_MAJOR_RECORD, "record")
    reason = F.when(_unreadable("record"), "not a record").when(F.coalesce(F.size("record.frames"), F.lit(0)) < 1, "no entities")
    return _split(parsed, "time_major", reason, "record.n", "record.frames")


def entity_messages(messages: DataFrame, topic: str | None = None) -> Split:
    """Messages of one entity: ``value, timestamp, topic`` as they came, for ``raw.message_positions``; ``file`` of a reject is its topic."""
    own = messages if topic is None else messages.filter(F.col("topic") == topic)
    texts = own.withColumns({"file": F.col("topic"), "text": F.col("value").cast("string")})
    parsed = _as_json(texts, schemas.ENTITY_MESSAGE, "message")
    reason = F.when(_unreadable("message"), "not a message").when(
        F.col("message.FrameSet.MatchId").isNull() | F.col("message.Frame.N").isNull(), "no match or frame"
    )
    return _split(parsed, "messages", reason, *messages.columns)


def match_documents(files: DataFrame) -> Split:
    """Whole XML files to documents in the shape of ``files.match_documents``; a file may hold several.

    A file without a complete document is rejected as a whole, a document that does not parse or has no match by itself.
    """
    found = F.regexp_extract_all("text", F.lit(_DOCUMENT), F.lit(0))
    cut = files.select("file", F.explode(F.when(F.size(found) > 0, F.transform(found, lambda d: F.struct(F.lit(True).alias("whole"), d.alias("text")))).otherwise(
        F.array(F.struct(F.lit(False).alias("whole"), F.col("text").alias("text")))
    )).alias("part")).select("file", "part.*")
    whole = T.StructType([*schemas.MATCH_INFORMATION_XML.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"rowTag": "MatchInformation", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = cut.withColumn("document", F.when(F.col("whole"), F.from_xml("text", whole.simpleString(), options)))
    match_id = F.col("document.General._MatchId")
    reason = F.when(~F.col("whole"), "no document").when(_unreadable("document"), "not a document").when(
        match_id.isNull() | (match_id == ""), "no match"
    )
    fields = [F.col(f"document.{name}").alias(name) for name in schemas.MATCH_INFORMATION_XML.names]
    return _split(parsed, "match_documents", reason, *fields, F.col("file").alias("source_file"))


def match_overrides(files: DataFrame) -> Split:
    """Whole JSON files to the rows of ``files.match_overrides``."""
    parsed = _as_json(files, schemas.MATCH_INFO, "document")
    columns = [F.col(f"document.{name}").alias(name) for name in ("pitch_x", "pitch_y", "home_team_id", "guest_team_id")]
    return _split(parsed, "match_overrides", F.when(_unreadable("document"), "not a document"), named_override("document.match_id", "file"), *columns)
