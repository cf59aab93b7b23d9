"""Gold stage, batch flavour: possession sequences over active play."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.numeric import mean_from_scaled, scaled_sum
from touchline.operators.ranked import kth_row
from touchline.operators.runs import BLOCK, consecutive_runs
from touchline.sources.constants import FRAMES_PER_SECOND, OFFSIDE_LINE_INDEX

FRAME = ["match_id", "game_section", "frame_id"]
# Decimals of the averaged columns; silver keeps three for speeds, two for lines.
SPEED_DIGITS = 3
LINE_DIGITS = 2


def active(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("ball_status") == 1)


def _team_has_ball() -> Column:
    return F.col("ball_possession") == F.col("team_id")


def offside_lines(rows: DataFrame, k: int = OFFSIDE_LINE_INDEX) -> DataFrame:
    """Position of the k-th deepest player of the possessing side and of its opponents, per frame."""
    players = rows.filter((F.col("team_id") != schemas.BALL) & F.col("ball_possession").isNotNull())
    sided = players.filter(F.col("x_norm").isNotNull()).select(*FRAME, _team_has_ball().alias("_own"), "x_norm")
    line = kth_row(sided, [*FRAME, "_own"], [F.col("x_norm")], k)
    return line.groupBy(*FRAME).agg(
        F.max(F.when(F.col("_own"), F.col("x_norm"))).alias("offside_line"),
        F.max(F.when(~F.col("_own"), F.col("x_norm"))).alias("opponent_offside_line"),
    )


def frame_summary(silver: DataFrame, k: int = OFFSIDE_LINE_INDEX) -> DataFrame:
    """One row per active frame: possessing team, opponent, ball speed and both offside lines.

    One pass: rows are ranked within the own and the other side of their frame, and one aggregate takes the rows of rank ``k`` beside
    the rest of the frame's values. Rows that were filled down are dealt by frame already; both steps then go on without an exchange.
    """
    is_ball, own = F.col("team_id") == schemas.BALL, F.coalesce(_team_has_ball(), F.lit(False))
    placed = ~is_ball & F.col("ball_possession").isNotNull() & F.col("x_norm").isNotNull()
    sided = active(silver).withColumn("_side", F.when(placed, F.when(own, "own").otherwise("other")))
    rank = F.row_number().over(Window.partitionBy(*FRAME, "_side").orderBy("x_norm"))

    def line(side: str) -> Column:
        return F.max(F.when((F.col("_side") == side) & (F.col("_rank") == k + 1), F.col("x_norm")))

    opponent = ~is_ball & F.col("ball_possession").isNotNull() & ~own
    return sided.withColumn("_rank", rank).groupBy(*FRAME).agg(
        F.max("ball_possession").alias("team_id"),
        F.max(F.when(opponent, F.col("team_id"))).alias("opponent_id"),
        F.max(F.when(is_ball, F.col("speed"))).alias("ball_speed"),
        line("own").alias("offside_line"),
        line("other").alias("opponent_offside_line"),
    )


AVERAGED = {
    "avg_ball_speed": ("ball_speed", SPEED_DIGITS),
    "avg_offside_line": ("offside_line", LINE_DIGITS),
    "opponent_avg_offside_line": ("opponent_offside_line", LINE_DIGITS),
}


def sequence_partials() -> dict[str, Column]:
    partials = {"opponent_id": F.max("opponent_id"), "num_frames": F.count(F.lit(1))}
    for name, (value, digits) in AVERAGED.items():
        partials[f"{name}_sum"] = scaled_sum(F.col(value), digits)
        partials[f"{name}_n"] = F.count(value)
    return partials


def sequence_merges() -> dict[str, Column]:
    merges = {"opponent_id": F.max("opponent_id"), "num_frames": F.sum("num_frames")}
    for name in AVERAGED:
        merges[f"{name}_sum"] = F.sum(f"{name}_sum")
        merges[f"{name}_n"] = F.sum(f"{name}_n")
    return merges


def possession_runs(summary: DataFrame, width: int = BLOCK) -> DataFrame:
    """Runs of consecutive frames with one possessing team, as mergeable sums.

    Frames in which nobody has the ball form runs of a NULL team.
    """
    keys = ["match_id", "game_section", "team_id"]
    return consecutive_runs(summary, keys, "frame_id", sequence_partials(), sequence_merges(), width)


def sequence_columns(runs: DataFrame, rounded: bool = True) -> DataFrame:
    """The gold contract; ``rounded=False`` keeps averages and durations exact."""

    def value(column: Column) -> Column:
        return F.round(column, 2) if rounded else column

    averages = [
        value(mean_from_scaled(F.col(f"{name}_sum"), F.col(f"{name}_n"), digits)).alias(name)
        for name, (_, digits) in AVERAGED.items()
    ]
    return runs.select(
        "match_id", "game_section", "team_id", "opponent_id",
        F.col("run_start").alias("possession_id"),
        value(F.col("num_frames") / F.lit(float(FRAMES_PER_SECOND))).alias("duration_sec"),
        *averages,
    )


def gold_possessions(
    silver: DataFrame, k: int = OFFSIDE_LINE_INDEX, rounded: bool = True, width: int = BLOCK
) -> DataFrame:
    return sequence_columns(possession_runs(frame_summary(silver, k), width), rounded)
