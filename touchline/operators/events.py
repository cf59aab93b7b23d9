"""Match events: one flat record of the details, whatever the event type nested them under."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.schemas import EVENT_HEADER_FIELDS, EVENT_ONLY_FIELDS, PASS_FIELDS, PLAY_FIELDS


def flat_details(event: str = "event") -> Column:
    """Struct of 69 fields: play and pass fields from either level, the others as they are."""
    details = F.col(f"{event}.EventDetails")
    play = details["Play"]
    either = [F.coalesce(details[name], play[name]).alias(name) for name in PLAY_FIELDS]
    passes = [
        F.coalesce(details["Pass"][name], play["Pass"][name]).alias(f"Pass{name}") for name in PASS_FIELDS
    ]
    rest = [details[name].alias(name) for name in EVENT_ONLY_FIELDS]
    return F.struct(*either, *passes, *rest)


def flattened_events(messages: DataFrame, event: str = "event") -> DataFrame:
    """Header columns and the flat ``EventDetails`` of parsed event messages."""
    header = [F.col(f"{event}.`{name}`").alias(name) for name in EVENT_HEADER_FIELDS]
    return messages.select(flat_details(event).alias("EventDetails"), *header)
