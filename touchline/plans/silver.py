"""Silver stage: ball distance, ball carrier, opponent pairs and target distance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.geometry import distance_to_point
from touchline.operators import frames, nearest
from touchline.operators.lineage import checkpointed
from touchline.sources import constants

KEYS = frames.KEYS
# Some twenty times the entities on a pitch; frames above it take the cell search.
MAX_FRAME_ROWS = 512


@dataclass(frozen=True)
class Flavour:
    """Where batch and streaming enrichment differ."""

    x: str
    y: str
    target: tuple[float, float]
    fill_down: bool
    keep_referee: bool
    columns: tuple[str, ...]


BATCH = Flavour("x", "y", constants.BATCH_TARGET_POINT, True, False, tuple(schemas.SILVER_COLUMNS))
STREAM = Flavour(
    "x_norm", "y_norm", constants.STREAM_TARGET_POINT, False, True, tuple(schemas.SILVER_STREAM_COLUMNS)
)

ROUNDED = (
    "x", "y", "x_norm", "y_norm", "distance", "speed", "acceleration", "ball_distance",
    "pair_player_distance", "closest_opponent_distance", "target_distance",
)


def identified(rows: DataFrame, flavour: Flavour = BATCH, strict: bool = False) -> DataFrame:
    """Rows with usable ids. The ball needs no person id unless ``strict``; the referee stays in streams."""
    team = F.col("team_id")
    known = F.col("match_id").isNotNull() & F.col("frame_id").isNotNull() & team.isNotNull()
    if flavour.keep_referee:
        return rows.filter(known & (F.col("person_id").isNotNull() | team.isin(schemas.BALL, schemas.REFEREE)))
    person = F.col("person_id").isNotNull()
    if not strict:
        person = person | (team == schemas.BALL)
    return rows.filter(known & person & (team != schemas.REFEREE))


def _anchored(rows: DataFrame, flavour: Flavour) -> DataFrame:
    """Needs ``_ball``: distances to ball and target; possession and status filled down at the end."""
    return rows.withColumns(
        {
            "ball_distance": frames.distance_to_ball(flavour.x, flavour.y),
            "target_distance": distance_to_point(F.col("x_norm"), F.col("y_norm"), flavour.target),
        }
    )


def _ordinary(rows: DataFrame, flavour: Flavour) -> DataFrame:
    """Frames up to the row limit: one exchange by frame, then one row of arrays per frame."""
    x, y = flavour.x, flavour.y
    flagged = rows.withColumns({"_eligible": frames.eligible(), "_located": frames.located(x, y)})
    ball = F.min(F.when(F.col("team_id") == schemas.BALL, frames.first_ball(x, y)))
    groups = nearest.gather(flagged, KEYS, "_eligible", _ball=ball)
    groups = groups.withColumn("_carrier", frames.gathered_carrier("_rows", "_located", x, y))
    paired = _anchored(nearest.pair_gathered(groups, "_eligible", x, y), flavour)
    return paired.withColumn("has_possession", frames.is_carrier(F.col("_carrier"))).drop(
        "_eligible", "_located", "_carrier"
    )


def _crowded(rows: DataFrame, flavour: Flavour) -> DataFrame:
    """Frames above the row limit: aggregates, joins and the cell search; nothing is gathered."""
    anchored = _anchored(frames.with_ball(rows, flavour.x, flavour.y), flavour)
    keyed = frames.halved(frames.with_carrier(anchored))
    return nearest.pair_by_cells(keyed, frames.JOINED, frames.eligible(), flavour.x, flavour.y).drop("_half")


def _rounded(name: str) -> Column:
    if name not in ROUNDED:
        return F.col(name)
    return F.when(~F.isnan(name), F.round(name, 3)).alias(name)


def enrich(bronze: DataFrame, flavour: Flavour = BATCH, max_frame_rows: int = MAX_FRAME_ROWS) -> DataFrame:
    """Enriches identified rows; values are unrounded and helper columns dropped.

    Frame sizes are counted first, over the key columns only. Where no frame is crowded,
    as in any real match, the plan is the ordinary one alone.
    """
    needed = [c for c in bronze.columns if c in flavour.columns]
    rows = bronze.select(*needed)
    keyed = frames.halved(rows)
    crowded = nearest.crowded_groups(keyed, frames.JOINED, max_frame_rows)
    if crowded.isEmpty():
        enriched = _ordinary(rows, flavour)
    else:
        crowded = checkpointed(crowded)
        ordinary = _ordinary(keyed.join(crowded, frames.JOINED, "left_anti").select(*needed), flavour)
        large = _crowded(checkpointed(crowded.join(keyed, frames.JOINED).select(*needed)), flavour)
        enriched = ordinary.unionByName(large.select(*ordinary.columns))
    if flavour.fill_down:
        enriched = enriched.withColumns(
            {
                "ball_possession": frames.filled("ball_possession", "possession"),
                "ball_status": frames.filled("ball_status", "status"),
            }
        )
    return enriched.drop("_ball")


def silver_positions(
    bronze: DataFrame,
    flavour: Flavour = BATCH,
    max_frame_rows: int = MAX_FRAME_ROWS,
    batch_id: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """The silver contract, rounded to three decimals and without NaN; ``batch_id`` adds the lineage column."""
    enriched = enrich(identified(bronze, flavour, strict), flavour, max_frame_rows)
    silver = enriched.select(*[_rounded(c) for c in flavour.columns])
    if batch_id is None:
        return silver
    return silver.withColumn("stream_batch_id", F.lit(batch_id).cast("bigint"))
