"""Raw stage: typed tracking rows from nested records or from messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.sources import messages as message_source


def number(text: Column) -> Column:
    """Text or number as double; malformed text and NaN become NULL instead of failing the job."""
    value = text.try_cast("double")
    return F.when(~F.isnan(value), value)


def whole(text: Column, kind: str = "int") -> Column:
    """Text or number as a whole number, also where it is written as ``1.0``; anything else becomes NULL."""
    value = text.try_cast("double")
    return F.coalesce(text.try_cast(kind), F.when(value == F.floor(value), value.try_cast(kind)))


#: How each field of a frame is read; the audit counts what these turn into NULL.
READ = {
    "N": lambda text: whole(text, "bigint"), "T": F.try_to_timestamp, "X": number, "Y": number, "Z": number, "D": number,
    "S": number, "A": number, "M": whole, "BallPossession": whole, "BallStatus": whole,
}


def explode_frames(records: DataFrame) -> DataFrame:
    """One row per entity; records with an empty or missing array give none."""
    return records.select(F.col("n").alias("frame_id"), F.explode("frames").alias("entity"))


def raw_positions(records: DataFrame) -> DataFrame:
    """Time-major records to the raw table."""
    frame, owner = F.col("entity.Frame"), F.col("entity.FrameSet")
    return explode_frames(records).select(
        owner["MatchId"].alias("match_id"),
        owner["GameSection"].alias("game_section"),
        F.col("frame_id"),
        owner["TeamId"].alias("team_id"),
        owner["PersonId"].alias("person_id"),
        F.try_to_timestamp(frame["T"]).alias("timestamp"),
        number(frame["X"]).alias("x"),
        number(frame["Y"]).alias("y"),
        number(frame["Z"]).alias("z"),
        number(frame["D"]).alias("distance"),
        number(frame["S"]).alias("speed"),
        number(frame["A"]).alias("acceleration"),
        whole(frame["M"]).alias("m_flag"),
        whole(frame["BallPossession"]).alias("ball_possession"),
        whole(frame["BallStatus"]).alias("ball_status"),
    )


def message_positions(messages: DataFrame, topic: str | None = None) -> DataFrame:
    """Entity messages to raw rows; the frame time stays text, the arrival rides along."""
    frame, owner = F.col("position.Frame"), F.col("position.FrameSet")
    return message_source.parsed(messages, schemas.ENTITY_MESSAGE, topic, name="position").select(
        "_arrival_ms",
        owner["MatchId"].alias("match_id"),
        owner["GameSection"].alias("game_section"),
        whole(frame["N"], "bigint").alias("frame_id"),
        owner["TeamId"].alias("team_id"),
        owner["PersonId"].alias("person_id"),
        frame["T"].alias("timestamp"),
        number(frame["X"]).alias("x"),
        number(frame["Y"]).alias("y"),
        number(frame["D"]).alias("distance"),
        number(frame["S"]).alias("speed"),
        number(frame["A"]).alias("acceleration"),
        whole(frame["M"]).alias("m_flag"),
        whole(frame["BallPossession"]).alias("ball_possession_code"),
        whole(frame["BallStatus"]).alias("ball_status"),
    )


def as_entity(rows: DataFrame) -> Column:
    """Struct of one raw row in the shape of an entity message, every leaf as text."""
    leaf = {
        "A": "acceleration", "D": "distance", "M": "m_flag", "N": "frame_id", "S": "speed", "T": "timestamp",
        "X": "x", "Y": "y", "Z": "z", "BallPossession": "ball_possession", "BallStatus": "ball_status",
    }
    owner = {"GameSection": "game_section", "MatchId": "match_id", "PersonId": "person_id", "TeamId": "team_id"}

    def texts(names: dict[str, str]) -> list[Column]:
        present = {k: c for k, c in names.items() if c in rows.columns}
        return [F.col(c).cast("string").alias(k) for k, c in present.items()]

    return F.struct(F.struct(*texts(leaf)).alias("Frame"), F.struct(*texts(owner)).alias("FrameSet"))
