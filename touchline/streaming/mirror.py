"""Raw mirrors: the parsed messages of a topic, appended to a table as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from touchline.operators.events import flattened_events
from touchline.sources import constants
from touchline.sources.messages import event_messages, match_information_messages


def _start(rows: DataFrame, path: str, checkpoint: str, interval: str | None) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def mirror_events(
    messages: DataFrame, path: str, checkpoint: str, topic: str | None = None,
    interval: str | None = constants.TRIGGER_INTERVAL,
) -> StreamingQuery:
    return _start(flattened_events(event_messages(messages, topic)), path, checkpoint, interval)


def mirror_match_information(
    messages: DataFrame, path: str, checkpoint: str, topic: str | None = None,
    interval: str | None = constants.TRIGGER_INTERVAL,
) -> StreamingQuery:
    return _start(match_information_messages(messages, topic).select("document.*"), path, checkpoint, interval)
