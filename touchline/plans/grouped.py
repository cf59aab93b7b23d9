"""Grouped stage: one row per team and frame, and the streaming flavour of gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.numeric import clock, mean_from_scaled, scaled_sum
from touchline.operators.kept import keep
from touchline.operators.runs import BLOCK, running_totals, value_runs
from touchline.sources.constants import FRAMES_PER_SECOND, OFFSIDE_LINE_INDEX

TEAM_FRAME = ["match_id", "team_id", "frame_id", "game_section"]
FRAME = list(schemas.FRAME_KEYS)
SECTION = ["match_id", "game_section"]


def grouped_positions(silver: DataFrame, k: int = OFFSIDE_LINE_INDEX) -> DataFrame:
    """Players of a team in a frame as an array from the deepest on, with line and play state.

    Players without a position come last, equal positions in the order of person ids. The ball's
    status is spread over its frame before grouping: rows are then hashed by frame, and neither
    the grouping by team nor a later window over the frame has to shuffle the arrays. The array
    of a team is the result itself, so it is as long as the team has rows in the frame.
    """
    player = F.struct(*schemas.GROUPED_PLAYER_COLUMNS)
    depth = F.struct(
        F.col("x_norm").isNull().alias("unplaced"), F.col("x_norm").alias("at"),
        F.col("person_id").alias("who"), player.alias("player"),
    )
    status = F.when(F.col("team_id") == schemas.BALL, F.col("ball_status"))
    rows = silver.filter(F.col("team_id") != schemas.REFEREE).withColumn(
        "_status", F.max(status).over(Window.partitionBy(*FRAME))
    )
    carried = [c for c in ("stream_batch_id", "_arrival_ms") if c in silver.columns]
    sorted_players = F.transform(F.array_sort(F.collect_list(depth)), lambda entry: entry["player"])
    grouped = rows.groupBy(*TEAM_FRAME).agg(
        sorted_players.alias("players"),
        F.when(F.max("_status") == 1, "active").otherwise("interruption").alias("play_state"),
        *[F.max(c).alias(c) for c in carried],
    )
    with_line = grouped.withColumn("offside_line", F.get("players", F.lit(k))["x_norm"])
    return with_line.select(*schemas.GROUPED_COLUMNS, *carried)


def _holder() -> Column:
    """The ball group's possession for every team row of the frame; a frame has a handful of them."""
    entry = F.get("players", F.lit(0))["ball_possession"]
    return F.max(F.when(F.col("team_id") == schemas.BALL, entry)).over(Window.partitionBy(*FRAME))


def possession_frames(grouped: DataFrame) -> DataFrame:
    """Rows of the team that has the ball, with the opponent's id and line of the same frame."""
    teams = grouped.withColumn("_holder", _holder()).filter(F.col("team_id") != schemas.BALL)
    has_ball = F.col("_holder") == F.col("team_id")
    frame = Window.partitionBy(*FRAME)
    deepest = F.get("players", F.lit(0))
    return (
        teams.withColumns(
            {
                "opponent_id": F.max(F.when(~has_ball, F.col("team_id"))).over(frame),
                "opponent_offside_line": F.max(F.when(~has_ball, F.col("offside_line"))).over(frame),
            }
        )
        .filter(has_ball)
        .select(
            *TEAM_FRAME, "opponent_id", "offside_line", "opponent_offside_line", "play_state",
            F.when(deepest["distance"] > 0, deepest["speed"]).alias("deepest_speed"),
        )
    )


AVERAGED = {
    "avg_ball_speed": ("deepest_speed", 3),
    "avg_offside_line": ("offside_line", 2),
    "opponent_avg_offside_line": ("opponent_offside_line", 2),
}


def sequence_partials() -> dict[str, Column]:
    partials = {
        "num_frames": F.count(F.lit(1)),
        "active_frames": F.count_if(F.col("play_state") == "active"),
        "interruption_frames": F.count_if(F.col("play_state") == "interruption"),
        "opponent_id": F.max("opponent_id"),
    }
    for name, (value, digits) in AVERAGED.items():
        partials[f"{name}_sum"] = scaled_sum(F.col(value), digits)
        partials[f"{name}_n"] = F.count(value)
    return partials


def sequence_merges() -> dict[str, Column]:
    sums = ["num_frames", "active_frames", "interruption_frames"]
    sums += [f"{name}_{part}" for name in AVERAGED for part in ("sum", "n")]
    return {"opponent_id": F.max("opponent_id"), **{name: F.sum(name) for name in sums}}


def possession_runs(frames: DataFrame, width: int = BLOCK) -> DataFrame:
    """Runs of possession frames of one team; gaps between frames do not end a run."""
    return value_runs(frames, SECTION, "frame_id", "team_id", sequence_partials(), sequence_merges(), width)


def with_ordinals(runs: DataFrame, width: int = BLOCK) -> DataFrame:
    """Ordinal of each sequence in its half and the frames played up to its end."""
    return running_totals(
        runs, SECTION, "run_start",
        {"possession_id": F.lit(1), "cumulative_frames": F.col("num_frames")}, width,
    )


def with_clipped(runs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Flags sequences that reach the first or last frame at hand of their half."""
    keys = keys or SECTION
    # A window over the sequences, of which there are few: a join with their own edges would run all before it twice.
    half = Window.partitionBy(*keys)
    touches = (F.col("run_start") <= F.min("run_start").over(half)) | (F.col("run_end") >= F.max("run_end").over(half))
    return runs.withColumn("sequence_clipped", touches)


def sequence_columns(runs: DataFrame, batch_id: int | None, rounded: bool = True) -> DataFrame:
    """The streaming gold contract, with nested metrics; ``rounded=False`` keeps averages exact."""

    def average(name: str) -> Column:
        digits = AVERAGED[name][1]
        mean = mean_from_scaled(F.col(f"{name}_sum"), F.col(f"{name}_n"), digits)
        return F.round(mean, 2) if rounded else mean

    rate = F.lit(float(FRAMES_PER_SECOND))
    seconds = F.col("num_frames") / rate
    return runs.select(
        "possession_id", "match_id", "game_section",
        # From whole frames: a running sum of fractional seconds can land just below a second.
        clock(F.floor(F.col("cumulative_frames") / FRAMES_PER_SECOND)).alias("cumulative_time"),
        "team_id", "opponent_id",
        F.col("run_start").alias("start_frame"), F.col("run_end").alias("end_frame"), "num_frames",
        seconds.alias("duration_sec"),
        F.round(seconds / 60, 2).alias("duration_min"),
        "active_frames", "interruption_frames",
        F.struct(
            average("avg_ball_speed").alias("avg_ball_speed"), average("avg_offside_line").alias("avg_offside_line")
        ).alias("team_metrics"),
        F.struct(average("opponent_avg_offside_line").alias("avg_offside_line")).alias("opponent_metrics"),
        F.lit(batch_id).cast("bigint").alias("stream_batch_id"),
        "sequence_clipped",
    )


def gold_stream_possessions(
    grouped: DataFrame, batch_id: int | None = None, rounded: bool = True, width: int = BLOCK
) -> DataFrame:
    # Kept: the ordinals and the clip flag each look at the sequences once more, and would
    # otherwise run everything up to here again. There is about one for every fifty frames.
    runs = keep(possession_runs(possession_frames(grouped), width))
    return sequence_columns(with_clipped(with_ordinals(runs, width)), batch_id, rounded)
