"""Bronze stage: possessing team, direction of attack and normalised coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.geometry import normalise_x, normalise_y
from touchline.operators.lookup import attach, bounded
from touchline.sources import constants
from touchline.sources.match_info import one_per_match

SECTION = ["match_id", "game_section"]


def outfield(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("team_id").isin(schemas.BALL, schemas.REFEREE))


def direction_vote(rows: DataFrame) -> DataFrame:
    """+1 where a team's leftmost player stands farther from the centre than its rightmost one."""
    leftmost, rightmost = F.abs(F.min("x")), F.abs(F.max("x"))
    return rows.groupBy(*SECTION, "team_id").agg(
        F.when(leftmost > rightmost, 1).otherwise(-1).alias("attack_direction")
    )


def kickoff_directions(rows: DataFrame, frames: tuple[int, ...] = constants.KICKOFF_FRAMES) -> DataFrame:
    """Direction per match, half and team from the fixed kickoff frames.

    The frame filter reaches the scan, so only the row groups of those frames are read.
    """
    return direction_vote(outfield(rows).filter(F.col("frame_id").isin(*frames)))


def first_frames(rows: DataFrame) -> DataFrame:
    """First frame of each match and half in which a player has a position."""
    located = outfield(rows).filter(F.col("x").isNotNull())
    return located.groupBy(*SECTION).agg(F.min("frame_id").alias("kickoff_frame_id"))


def first_frame_players(rows: DataFrame) -> DataFrame:
    located = outfield(rows).filter(F.col("x").isNotNull())
    first = first_frames(rows).withColumnRenamed("kickoff_frame_id", "frame_id")
    return attach(located, bounded(first), [*SECTION, "frame_id"], "inner")


def earliest_directions(rows: DataFrame) -> DataFrame:
    """Direction per match, half and team from the first frame at hand."""
    return direction_vote(first_frame_players(rows))


def constant_directions(rows: DataFrame, directions: DataFrame, half_starts: DataFrame) -> DataFrame:
    """Direction of each row from a fixed first-half table, turned round from the second half on."""
    joined = attach(attach(rows, directions, ["match_id", "team_id"]), half_starts, ["match_id"])
    first = F.col("first_half_direction")
    turned = F.when(F.col("frame_id") >= F.col("half_start_frame"), -first).otherwise(first)
    return joined.withColumn("attack_direction", turned).drop("first_half_direction", "half_start_frame")


def possessing_team(code: Column) -> Column:
    """Code 1 is the home team, 2 the guest team, anything else nobody."""
    return F.when(code == 1, F.col("home_team_id")).when(code == 2, F.col("guest_team_id"))


def with_match_info(rows: DataFrame, info: DataFrame, default_pitch: bool = False) -> DataFrame:
    """Pitch and teams of each row's match."""
    joined = attach(rows, bounded(one_per_match(info)), ["match_id"])
    if not default_pitch:
        return joined
    return joined.withColumns(
        {
            "pitch_x": F.coalesce("pitch_x", F.lit(constants.PITCH_X)),
            "pitch_y": F.coalesce("pitch_y", F.lit(constants.PITCH_Y)),
        }
    )


def with_possessing_team(rows: DataFrame, code: str = "ball_possession") -> DataFrame:
    return rows.withColumn("ball_possession", possessing_team(F.col(code)))


def with_direction(rows: DataFrame, directions: DataFrame, every_row: bool = False) -> DataFrame:
    """Own direction of each row; the ball takes that of the possessing team.

    With ``every_row`` any row without an own direction takes the possessing team's.
    """
    own = attach(rows, directions, [*SECTION, "team_id"])
    ball = directions.select(
        *SECTION,
        F.col("team_id").alias("ball_possession"),
        F.col("attack_direction").alias("_ball_direction"),
    )
    both = attach(own, ball, [*SECTION, "ball_possession"])
    if every_row:
        direction = F.coalesce("attack_direction", "_ball_direction")
    else:
        is_ball = F.col("team_id") == schemas.BALL
        direction = F.when(is_ball, F.col("_ball_direction")).otherwise(F.col("attack_direction"))
    return both.withColumn("attack_direction", direction).drop("_ball_direction")


def with_normalised(rows: DataFrame) -> DataFrame:
    direction = F.col("attack_direction")
    return rows.withColumns(
        {
            "x_norm": normalise_x(F.col("x"), direction, F.col("pitch_x")),
            "y_norm": normalise_y(F.col("y"), direction, F.col("pitch_y")),
        }
    )


def bronze_positions(raw: DataFrame, info: DataFrame, directions: DataFrame | None = None) -> DataFrame:
    """Batch flavour: kickoff directions, unknown matches have no pitch and no coordinates."""
    if directions is None:
        directions = kickoff_directions(raw)
    rows = with_possessing_team(with_match_info(raw, info))
    return with_normalised(with_direction(rows, bounded(directions))).select(*schemas.BRONZE_COLUMNS)


def bronze_stream_positions(rows: DataFrame, info: DataFrame, directions: DataFrame | None = None) -> DataFrame:
    """Streaming flavour: directions from the first frame at hand, default pitch for unknown matches."""
    if directions is None:
        directions = earliest_directions(rows)
    known = with_possessing_team(with_match_info(rows, info, default_pitch=True), "ball_possession_code")
    bronze = with_normalised(with_direction(known, bounded(directions), every_row=True))
    columns = list(schemas.BRONZE_STREAM_COLUMNS)
    if "_arrival_ms" in rows.columns:
        columns.append("_arrival_ms")
    return bronze.select(*columns)
