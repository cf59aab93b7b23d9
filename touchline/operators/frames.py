"""Operators within one frame: ball anchor, fill-down, ball carrier and frame-wide values.

Most operators here are a partial aggregate per frame joined back to the rows, so a frame
that holds very many rows is combined before the shuffle and its join is split at run time;
``fill_down`` is a window, which reads its rows once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.geometry import distance, is_finite
from touchline.schemas import BALL, FRAME_KEYS, REFEREE

KEYS = list(FRAME_KEYS)
# The same for joins: a half without a name is one too, and as structs two missing names are equal.
JOINED = ["match_id", "_half", "frame_id"]


def halved(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_half", F.struct("game_section"))


def first_ball(x: str = "x", y: str = "y") -> Column:
    """The frame's ball row as a struct; of several, the one with the smallest person id."""
    return F.struct(
        F.coalesce("person_id", F.lit("")).alias("person"),
        F.col(x).alias("x"),
        F.col(y).alias("y"),
        F.col("ball_possession").alias("possession"),
        F.col("ball_status").alias("status"),
    )


def with_ball(rows: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Adds ``_ball``, the frame's ball row, to every row of the frame."""
    keyed = halved(rows)
    ball = keyed.filter(F.col("team_id") == BALL).groupBy(*JOINED).agg(F.min(first_ball(x, y)).alias("_ball"))
    return keyed.join(ball, JOINED, "left").select(*rows.columns, "_ball")


def filled(name: str, ball_field: str) -> Column:
    return F.coalesce(F.col("_ball")[ball_field], F.col(name))


def fill_down(rows: DataFrame) -> DataFrame:
    """The ball row's possession and status, where present, hold for the whole frame.

    A window over the frame: the rows are read once and dealt by frame, and what follows per frame needs no other exchange.
    """
    ball = F.min(F.when(F.col("team_id") == BALL, first_ball("x", "y"))).over(Window.partitionBy(*KEYS))
    return rows.withColumn("_ball", ball).withColumns(
        {
            "ball_possession": filled("ball_possession", "possession"),
            "ball_status": filled("ball_status", "status"),
        }
    ).select(*rows.columns)


def located(*extra: str) -> Column:
    """Row with finite normalised coordinates (and finite values in ``extra``)."""
    result = is_finite(F.col("x_norm")) & is_finite(F.col("y_norm"))
    for name in extra:
        result = result & is_finite(F.col(name))
    return result


def distance_to_ball(x: str, y: str) -> Column:
    """Needs ``_ball``; NULL without a finite ball or without a position of the row."""
    ball = F.col("_ball")
    known = located(x, y) & is_finite(ball["x"]) & is_finite(ball["y"])
    return F.when(known, distance(F.col(x), F.col(y), ball["x"], ball["y"]))


def ball_distance(rows: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    return with_ball(rows, x, y).withColumn("ball_distance", distance_to_ball(x, y)).select(*rows.columns, "ball_distance")


def carrier_candidate() -> Column:
    """Needs ``_ball`` and ``ball_distance``: present rows of the possessing team near a known ball."""
    possessing = F.col("team_id") == F.col("_ball")["possession"]
    return F.coalesce(possessing, F.lit(False)) & F.col("person_id").isNotNull() & F.col("ball_distance").isNotNull()


def carrier_rank() -> Column:
    return F.when(carrier_candidate(), F.struct(F.col("ball_distance").alias("d"), F.col("person_id").alias("person")))


def is_carrier(best: Column) -> Column:
    nearest = (F.col("person_id") == best["person"]) & (F.col("ball_distance") == best["d"])
    return F.coalesce(carrier_candidate() & nearest, F.lit(False))


def with_carrier(anchored: DataFrame) -> DataFrame:
    """Adds ``has_possession``: the possessing team's row nearest to the ball, ties by person id."""
    keyed = halved(anchored)
    best = keyed.filter(carrier_candidate()).groupBy(*JOINED).agg(F.min(carrier_rank()).alias("_carrier"))
    flagged = keyed.join(best, JOINED, "left").withColumn("has_possession", is_carrier(F.col("_carrier")))
    return flagged.select(*anchored.columns, "has_possession")


def ball_carriers(rows: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    anchored = with_ball(rows, x, y).withColumn("ball_distance", distance_to_ball(x, y))
    return with_carrier(anchored).select(*rows.columns, "ball_distance", "has_possession")


def gathered_carrier(rows: str, placed: str, x: str, y: str) -> Column:
    """``carrier_rank`` of the best row of a gathered frame; ``placed`` flags rows with a position."""
    ball = F.col("_ball")
    candidates = F.filter(
        rows,
        lambda row: row[placed] & row["person_id"].isNotNull()
        & F.coalesce(row["team_id"] == ball["possession"], F.lit(False)),
    )
    best = F.array_min(
        F.transform(
            candidates,
            lambda row: F.struct(
                distance(row[x], row[y], ball["x"], ball["y"]).alias("d"), row["person_id"].alias("person")
            ),
        )
    )
    return F.when(is_finite(ball["x"]) & is_finite(ball["y"]), best)


def eligible() -> Column:
    """Players that take part in pairing."""
    return ~F.col("team_id").isin(BALL, REFEREE) & F.col("person_id").isNotNull() & located()
