"""Data-quality reports. Each is a table, never a list on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators.frames import eligible
from touchline.operators.lookup import attach, bounded
from touchline.plans.raw import READ
from touchline.sources.match_info import one_per_match


def unresolved_directions(bronze: DataFrame) -> DataFrame:
    """Per match and half with rows that got no direction: how many of all rows, and their share.

    Their coordinates were normalised as if the direction were -1.
    """
    missing = F.count_if(F.col("attack_direction").isNull())
    halves = bronze.groupBy("match_id", "game_section").agg(F.count("*").alias("total_rows"), missing.alias("unresolved_rows"))
    share = F.round(F.col("unresolved_rows") / F.col("total_rows"), 4).alias("unresolved_share")
    return halves.where("unresolved_rows > 0").select("*", share)


def unknown_matches(rows: DataFrame, info: DataFrame) -> DataFrame:
    """Matches of the rows for which the home or guest team is not known."""
    known = info.filter(F.col("home_team_id").isNotNull() & F.col("guest_team_id").isNotNull())
    matches = rows.filter(F.col("match_id").isNotNull()).select("match_id").distinct()
    return matches.join(known, "match_id", "left_anti")


def checked_matches(rows: DataFrame, info: DataFrame) -> DataFrame:
    """The rows as they are, in a plan that fails at the first row of a match whose home or guest team is not known."""
    known = one_per_match(info).filter(F.col("home_team_id").isNotNull() & F.col("guest_team_id").isNotNull())
    joined = attach(rows, bounded(known.select("match_id", F.lit(True).alias("_known"))), ["match_id"])
    unknown = F.raise_error(F.concat(F.lit("no metadata for match "), "match_id")).cast("boolean")
    return joined.filter(F.when(F.col("match_id").isNull() | F.coalesce("_known", F.lit(False)), True).otherwise(unknown)).drop("_known")


def frames_with_extra_teams(rows: DataFrame) -> DataFrame:
    """Frames with players of more than two teams; pairing uses the two smallest team ids."""
    teams = rows.filter(eligible()).select("match_id", "frame_id", "team_id").distinct()
    return (
        teams.groupBy("match_id", "frame_id").agg(F.count(F.lit(1)).alias("teams")).filter(F.col("teams") > 2)
    )


def repeated_rows(rows: DataFrame) -> DataFrame:
    """Row keys that occur more than once."""
    return rows.groupBy(*schemas.ROW_KEYS).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def malformed_numbers(entities: DataFrame, frame: str = "entity.Frame") -> DataFrame:
    """Per field of a frame, how many values the raw stage turns into NULL; it reads with the very same casts."""
    fields = [name for name in READ if name in entities.select(f"{frame}.*").columns]

    def malformed(name: str) -> Column:
        text = F.col(f"{frame}.{name}")
        return text.isNotNull() & READ[name](text).isNull()

    counts = entities.agg(*[F.count_if(malformed(name)).alias(name) for name in fields])
    return counts.unpivot([], fields, "field", "malformed")


def alignment(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Compares two tables row by row: per column, how many common rows differ.

    The rows ``(only left)`` and ``(only right)`` count keys without a partner. Keys may be NULL.
    """
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    taken = dict.fromkeys([*keys, *columns])
    tagged_left = left.select(*taken, F.lit(True).alias("_here")).alias("l")
    tagged_right = right.select(*taken, F.lit(True).alias("_here")).alias("r")
    both = tagged_left.join(tagged_right, condition, "full")
    common = F.col("l._here").isNotNull() & F.col("r._here").isNotNull()
    counts = [
        F.count_if(common & ~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))).alias(c) for c in columns
    ]
    lone = [
        F.count_if(F.col("r._here").isNull()).alias("(only left)"),
        F.count_if(F.col("l._here").isNull()).alias("(only right)"),
    ]
    names = [*columns, "(only left)", "(only right)"]
    return both.agg(*counts, *lone).unpivot([], names, "column_name", "differing_rows")
