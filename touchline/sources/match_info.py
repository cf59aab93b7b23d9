"""Match metadata and the goalkeeper catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.geometry import is_finite
from touchline.sources import constants

_INFO_COLUMNS = schemas.MATCH_INFO.names


def _number(text: Column) -> Column:
    value = text.try_cast("double")
    return F.when(is_finite(value), value)


def match_info(documents: DataFrame) -> DataFrame:
    """The five metadata columns of each XML document."""
    return documents.select(
        F.col("General._MatchId").alias("match_id"),
        _number(F.col("Environment._PitchX")).alias("pitch_x"),
        _number(F.col("Environment._PitchY")).alias("pitch_y"),
        F.col("General._HomeTeamId").alias("home_team_id"),
        F.col("General._GuestTeamId").alias("guest_team_id"),
    )


def one_per_match(info: DataFrame) -> DataFrame:
    """Drops repeats of a match, keeping the smallest row, so that a join cannot multiply rows."""
    rest = [c for c in info.columns if c != "match_id"]
    return (
        info.filter(F.col("match_id").isNotNull())
        .groupBy("match_id")
        .agg(F.min(F.struct(*rest)).alias("_info"))
        .select("match_id", *[F.col(f"_info.{c}").alias(c) for c in rest])
    )


def overlay(overrides: DataFrame, known: DataFrame) -> DataFrame:
    """Override documents replace the known row of their match; pitch sizes have defaults."""
    ranked = overrides.select(*_INFO_COLUMNS, F.lit(0).alias("_rank")).unionByName(
        known.select(*_INFO_COLUMNS, F.lit(1).alias("_rank"))
    )
    rest = _INFO_COLUMNS[1:]
    chosen = ranked.groupBy("match_id").agg(F.min(F.struct("_rank", *rest)).alias("_info"))
    return chosen.select("match_id", *[F.col(f"_info.{c}").alias(c) for c in rest]).withColumns(
        {
            "pitch_x": F.coalesce("pitch_x", F.lit(constants.PITCH_X)),
            "pitch_y": F.coalesce("pitch_y", F.lit(constants.PITCH_Y)),
        }
    )


def _plain(path: str, names) -> Column:
    return F.struct(*[F.col(f"{path}._{name}").alias(name) for name in names])


def _plain_item(item: Column, names) -> Column:
    return F.struct(*[item[f"_{name}"].alias(name) for name in names])


def _plain_list(items: Column, names) -> Column:
    return F.coalesce(F.transform(items, lambda item: _plain_item(item, names)), F.array())


def parsed_documents(documents: DataFrame) -> DataFrame:
    """XML documents as plain nested records; documents without a match id are dropped."""

    def team(item: Column) -> Column:
        return F.struct(
            *[item[f"_{name}"].alias(name) for name in schemas.TEAM_FIELDS],
            _plain_list(item["Players"]["Player"], schemas.PLAYER_FIELDS).alias("Players"),
            _plain_list(item["TrainerStaff"]["Trainer"], schemas.STAFF_FIELDS).alias("TrainerStaff"),
        )

    match_id = F.col("General._MatchId")
    return documents.filter(match_id.isNotNull() & (match_id != "")).select(
        _plain("Environment", schemas.ENVIRONMENT_FIELDS).alias("Environment"),
        _plain("General", schemas.GENERAL_FIELDS).alias("General"),
        _plain("OtherGameInformation", schemas.PLAYING_TIME_FIELDS).alias("OtherGameInformation"),
        _plain_list(F.col("Referees.Referee"), schemas.STAFF_FIELDS).alias("Referees"),
        F.transform(F.col("Teams.Team"), team).alias("Teams"),
        "source_file",
    )


def goalkeepers(documents: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """Starting goalkeeper per team, from parsed documents in the order of ``source_file``.

    Within a document the last goalkeeper listed as a starter counts, else the first one
    listed; the first document that names one decides. ``fallback`` fills the other teams.
    """
    players = (
        documents.select("source_file", F.posexplode("Teams").alias("team_pos", "team"))
        .select("source_file", "team_pos", F.col("team.TeamId").alias("team_id"), F.col("team.Players").alias("players"))
        .filter(F.col("team_id").isNotNull() & (F.col("team_id") != ""))
        .select("source_file", "team_pos", "team_id", F.posexplode("players").alias("pos", "player"))
        .filter(F.upper("player.PlayingPosition") == "TW")
    )
    starts = F.lower("player.Starting").isin("true", "1", "yes")
    person = F.struct(F.col("player.PersonId").alias("id"))
    per_document = players.groupBy("source_file", "team_pos", "team_id").agg(
        F.coalesce(F.max_by(person, F.when(starts, F.col("pos"))), F.min_by(person, F.col("pos"))).alias("person")
    )
    loaded = (
        per_document.filter(F.col("person.id").isNotNull() & (F.col("person.id") != ""))
        .groupBy("team_id")
        .agg(F.min_by(F.col("person.id"), F.struct("source_file", "team_pos")).alias("loaded_id"))
    )
    if fallback is None:
        return loaded.select("team_id", F.col("loaded_id").alias("goalkeeper_id"))
    return loaded.join(fallback, "team_id", "full").select(
        "team_id", F.coalesce("loaded_id", "goalkeeper_id").alias("goalkeeper_id")
    )
