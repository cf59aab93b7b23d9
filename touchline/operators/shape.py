"""Measures on top of silver: lags, zones, team shape and areas of the pitch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.geometry import third
from touchline.functions.numeric import exact_mean
from touchline.operators.lookup import attach
from touchline.operators.runs import BLOCK, previous_values
from touchline.sources import constants

TEAM_FRAME = ["match_id", "game_section", "frame_id", "team_id"]
THIRDS = ("first-third", "second-third", "final-third")
LANES = ("left", "centre", "right")


def with_lags(
    silver: DataFrame, values: tuple[str, ...] = ("ball_distance",), max_gap: int = constants.FRAME_GAP_RESET,
    width: int = BLOCK,
) -> DataFrame:
    """``prev_*`` columns per half and player, empty after a gap of more than ``max_gap`` frames."""
    people = silver.filter(F.col("person_id").isNotNull())
    names = {f"prev_{name}": name for name in values}
    return previous_values(people, ["match_id", "game_section", "person_id"], "frame_id", names, max_gap, width)


def zone(x: Column, y: Column, pitch_x: Column, pitch_y: Column) -> Column:
    """Third of the length and lane, such as ``first-third-left``."""
    return F.concat(third(x, pitch_x, THIRDS), F.lit("-"), third(y, pitch_y, LANES))


def _pitch(pitch: tuple[float, float]) -> tuple[Column, Column]:
    return F.lit(float(pitch[0])), F.lit(float(pitch[1]))


def with_zones(rows: DataFrame, pitch: tuple[float, float] = (constants.PITCH_X, constants.PITCH_Y)) -> DataFrame:
    return rows.withColumn("pitch_zone", zone(F.col("x_norm"), F.col("y_norm"), *_pitch(pitch)))


def possession_zones(
    rows: DataFrame, pitch: tuple[float, float] = (constants.PITCH_X, constants.PITCH_Y)
) -> DataFrame:
    """Zone of the ball per frame, as the team in possession and as its opponent sees it."""
    length, width = _pitch(pitch)
    x, y = F.col("x_norm"), F.col("y_norm")
    return rows.filter(F.col("team_id") == schemas.BALL).select(
        "match_id", "game_section", "frame_id", "ball_possession",
        zone(x, y, length, width).alias("possession_zone"),
        zone(length - x, width - y, length, width).alias("opponent_zone"),
    )


def with_goalkeeper_flag(rows: DataFrame, goalkeepers: DataFrame) -> DataFrame:
    """``is_goalkeeper`` from a catalogue with one row per team."""
    flag = F.coalesce(F.col("person_id") == F.col("goalkeeper_id"), F.lit(False))
    return attach(rows, goalkeepers, ["team_id"]).withColumn("is_goalkeeper", flag).drop("goalkeeper_id")


def team_shape(rows: DataFrame, pitch_x: float = constants.PITCH_X) -> DataFrame:
    """Line, height and width of each team in each frame, without its goalkeeper.

    Needs ``is_goalkeeper``. All state is a few numbers per team and frame, combined before the shuffle.
    """
    players = rows.filter(~F.col("team_id").isin(schemas.BALL, schemas.REFEREE) & ~F.col("is_goalkeeper"))
    length = F.lit(float(pitch_x))
    return (
        players.groupBy(*TEAM_FRAME)
        .agg(
            F.round(F.min("x_norm"), 2).alias("offside_line"),
            exact_mean(F.col("x_norm"), 2).alias("avg_height"),
            F.round(F.max("x_norm") - F.min("x_norm"), 2).alias("height_span"),
            F.round(F.max("y_norm") - F.min("y_norm"), 2).alias("width"),
        )
        .withColumns(
            {
                "offside_line_perc": F.round(F.col("offside_line") * 100 / length, 2),
                "height_span_perc": F.round(F.col("height_span") * 100 / length, 2),
            }
        )
    )


def team_state(shape: DataFrame) -> DataFrame:
    """High or low block by the line, long or short team by the height span."""
    line = F.col("offside_line_perc") >= constants.OFFSIDE_LINE_PERCENT
    span = F.col("height_span_perc") >= constants.HEIGHT_SPAN_PERCENT
    block = F.when(line, "high").when(~line, "low")
    length = F.when(span, "long").when(~span, "short")
    return shape.withColumn("team_state", F.concat(block, F.lit("-"), length))


def motion_state(rows: DataFrame) -> DataFrame:
    """Play state per frame by the ball's own movement, one row per ball row."""
    state = F.when(F.col("distance") > 0, "active_play").otherwise("interruption")
    ball = rows.filter(F.col("team_id") == schemas.BALL)
    return ball.select("match_id", "game_section", "frame_id", state.alias("play_state"))


def in_penalty_area() -> Column:
    area = constants.PENALTY_AREA
    x = F.col("x_norm").between(area["x_min"], area["x_max"])
    return x & F.col("y_norm").between(area["y_min"], area["y_max"])


def penalty_area_presence(silver: DataFrame) -> DataFrame:
    """Per team and half: player positions in the attacked penalty area, and frames with any."""
    inside = silver.filter(~F.col("team_id").isin(schemas.BALL, schemas.REFEREE) & in_penalty_area())
    return (
        inside.groupBy(*TEAM_FRAME).agg(F.count(F.lit(1)).alias("players"))
        .groupBy("match_id", "game_section", "team_id")
        .agg(F.sum("players").alias("positions"), F.count(F.lit(1)).alias("frames"), F.max("players").alias("most_players"))
    )


def close_to_ball(silver: DataFrame, limit: float = constants.CLOSE_BALL_DISTANCE) -> DataFrame:
    """Players within ``limit`` metres of the ball."""
    return silver.filter((F.col("team_id") != schemas.BALL) & (F.col("ball_distance") <= limit))
