"""Every query by name: a callable of the session and the folder of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import schemas
from touchline.catalog import feeds, streams, tables
from touchline.catalog.tracking_view import match_info
from touchline.operators import events, frames, nearest, quality, shape
from touchline.operators.runs import value_runs
from touchline.plans import bronze, gold, grouped, raw, silver
from touchline.sources import match_info as info_source
from touchline.sources import messages, sinks
from touchline.session import tune

ROW = ["match_id", "game_section", "frame_id", "team_id", "person_id"]


# --- stages --------------------------------------------------------------------
def raw_tracking(spark: SparkSession, folder: str) -> DataFrame:
    """The stored raw table of the tracking view, built by the first query that needs it."""
    return tables.raw_table(spark, folder)


def tracking(spark: SparkSession, folder: str) -> DataFrame:
    return raw_tracking(spark, folder).withColumnRenamed("ball_possession", "ball_possession_code")


def _bronze(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.bronze_positions(raw_tracking(spark, folder), match_info(spark))


def _stream_rows(spark: SparkSession, folder: str) -> DataFrame:
    return raw_tracking(spark, folder).withColumnsRenamed({"ball_possession": "ball_possession_code"}).withColumn(
        "timestamp", F.unix_millis("timestamp").cast("string")
    )


def _bronze_stream(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.bronze_stream_positions(_stream_rows(spark, folder), match_info(spark))


def _known(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze rows with usable ids."""
    return silver.identified(_bronze(spark, folder))


def _filled(spark: SparkSession, folder: str) -> DataFrame:
    return frames.fill_down(_known(spark, folder))


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver_positions(_bronze(spark, folder))


def _silver_stream(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver_positions(_bronze_stream(spark, folder), silver.STREAM, batch_id=0)


def _grouped(spark: SparkSession, folder: str, k: int = 1) -> DataFrame:
    return grouped.grouped_positions(_silver_stream(spark, folder), k)


def _summary(spark: SparkSession, folder: str) -> DataFrame:
    return gold.frame_summary(_filled(spark, folder))


# --- raw -----------------------------------------------------------------------
def raw_explode_project(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.raw_rows(spark, folder)
    records = rows.groupBy("match_id", F.col("frame_id").alias("n")).agg(
        F.collect_list(raw.as_entity(rows)).alias("frames")
    )
    return raw.raw_positions(records.select("n", "frames")).select(
        *[c for c in schemas.RAW_COLUMNS if c != "timestamp"], F.unix_millis("timestamp").alias("epoch_ms")
    )


def _as_topic(rows: DataFrame, topic: str) -> DataFrame:
    text = rows.withColumn("timestamp", F.unix_millis("timestamp").cast("string"))
    entity = text.select(raw.as_entity(text).alias("entity"), F.timestamp_millis(F.lit(0)).alias("timestamp"))
    return entity.select(F.to_json("entity").alias("value"), "timestamp", F.lit(topic).alias("topic"))


def raw_from_json(spark: SparkSession, folder: str) -> DataFrame:
    topic = _as_topic(tables.raw_rows(spark, folder), "positions")
    return raw.message_positions(topic, "positions").drop("_arrival_ms")


def event_properties(spark: SparkSession, folder: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/events.parquet")
    topic = table.select(
        F.col("props").alias("value"), F.col("ts").alias("timestamp"), F.col("event_type").alias("topic")
    )
    properties = messages.parsed(topic, "k int", "click", name="props")
    return properties.groupBy(F.col("props.k").alias("k")).agg(
        F.count(F.lit(1)).alias("clicks"), F.max("_arrival_ms").alias("last_arrival_ms")
    )


def message_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["match_id", "frame_id", "team_id", "person_id", "x_norm", "y_norm", "ball_possession"]
    framed = sinks.as_messages(_bronze(spark, folder), columns)
    schema = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in schemas.BRONZE_POSITIONS if f.name in columns
    )
    return framed.select("key", F.from_json("value", schema).alias("row")).select("key", "row.*")


# --- bronze ----------------------------------------------------------------------
def kickoff_frames(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.first_frames(tracking(spark, folder))


def attack_direction(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.kickoff_directions(tables.raw_rows(spark, folder))


def attack_direction_earliest(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.earliest_directions(tracking(spark, folder))


def possession_team(spark: SparkSession, folder: str) -> DataFrame:
    """With the last match unknown: its rows have no teams and the default pitch."""
    known = bronze.with_match_info(raw_tracking(spark, folder), match_info(spark, 2), default_pitch=True)
    return bronze.with_possessing_team(known).select(*ROW, "ball_possession", "pitch_x", "pitch_y")


def bronze_positions(spark: SparkSession, folder: str) -> DataFrame:
    return _bronze(spark, folder).withColumn("timestamp", F.unix_millis("timestamp")).withColumnRenamed(
        "timestamp", "epoch_ms"
    )


def bronze_positions_stream(spark: SparkSession, folder: str) -> DataFrame:
    return _bronze_stream(spark, folder)


def constant_direction(spark: SparkSession, folder: str) -> DataFrame:
    info = match_info(spark)
    sides = F.array(
        F.struct(F.col("home_team_id").alias("team_id"), F.lit(1).alias("first_half_direction")),
        F.struct(F.col("guest_team_id").alias("team_id"), F.lit(-1).alias("first_half_direction")),
    )
    directions = info.select("match_id", F.inline(sides))
    half_starts = info.select("match_id", F.lit(100000).cast("bigint").alias("half_start_frame"))
    return bronze.constant_directions(tracking(spark, folder), directions, half_starts).select(
        *ROW, "attack_direction"
    )


# --- within a frame ------------------------------------------------------------------
def frame_fill_down(spark: SparkSession, folder: str) -> DataFrame:
    return _filled(spark, folder).select(*ROW, "ball_possession", "ball_status")


def target_distance(spark: SparkSession, folder: str) -> DataFrame:
    from touchline.functions.geometry import distance_to_point

    rows = _known(spark, folder)
    value = distance_to_point(F.col("x_norm"), F.col("y_norm"), silver.BATCH.target)
    return rows.select(*ROW, F.round(value, 3).alias("target_distance"))


def ball_distance(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.ball_distance(_known(spark, folder))
    return rows.select(*ROW, F.round("ball_distance", 3).alias("ball_distance"))


def ball_distance_norm(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.ball_distance(silver.identified(_bronze_stream(spark, folder), silver.STREAM), "x_norm", "y_norm")
    return rows.select(*ROW, F.round("ball_distance", 3).alias("ball_distance"))


def ball_carrier(spark: SparkSession, folder: str) -> DataFrame:
    carriers = frames.ball_carriers(_known(spark, folder)).filter("has_possession")
    return carriers.select(*ROW, F.round("ball_distance", 3).alias("ball_distance"))


def opponent_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Each mutual pair once, from the team with the smaller id."""
    pairs = _silver(spark, folder).filter(F.col("pair_player_id").isNotNull() & F.col("team_id").startswith("GUEST"))
    return pairs.select(*ROW, "pair_player_id", "pair_player_distance")


def nearest_opponent(spark: SparkSession, folder: str) -> DataFrame:
    """As silver finds it: one shuffle by frame, and the cell search for crowded frames."""
    found = silver.enrich(_known(spark, folder)).filter(F.col("closest_opponent_id").isNotNull())
    return found.select(
        "match_id", "frame_id", "team_id", "person_id", F.col("closest_opponent_id").alias("opponent_id"),
        F.round("closest_opponent_distance", 3).alias("opponent_distance"),
    )


def nearest_opponent_crowded(spark: SparkSession, folder: str) -> DataFrame:
    """The same over lines of orders as players in frames of several thousands, which take the cell search."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").where("l_returnflag <> 'N'")
    hundredths = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    players = lines.select(
        F.lit("L").alias("match_id"), F.floor(F.col("l_orderkey") / 12_000).alias("frame_id"), F.col("l_returnflag").alias("team_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string")).alias("person_id"),
        (hundredths % 10_501 / F.lit(100.0)).alias("x"), (F.floor(hundredths / 7) % 6_801 / F.lit(100.0)).alias("y"),
    ).distinct()
    keys = ["match_id", "frame_id"]
    found = nearest.nearest_by_cells(players, keys, "team_id", "person_id", "x", "y")
    return found.groupBy(*keys, "team_id").agg(
        F.count("*").alias("players"), F.sum(F.round(F.col("distance") * 1000).cast("bigint")).alias("distance_sum"), F.max("opponent").alias("last_opponent")
    )


# --- silver and grouped -----------------------------------------------------------------
def silver_positions(spark: SparkSession, folder: str) -> DataFrame:
    return _silver(spark, folder)


def silver_positions_stream(spark: SparkSession, folder: str) -> DataFrame:
    return _silver_stream(spark, folder)


def grouped_frames(spark: SparkSession, folder: str) -> DataFrame:
    def player(position: int, field: str) -> Column:
        return F.get("players", F.lit(position))[field]

    return _grouped(spark, folder).select(
        *grouped.TEAM_FRAME,
        F.size("players").alias("num_players"),
        player(0, "person_id").alias("deepest_id"),
        player(0, "x_norm").alias("deepest_x"),
        player(1, "person_id").alias("second_id"),
        F.array_join(F.transform("players", lambda p: F.coalesce(p["person_id"], F.lit("-"))), ",").alias("player_ids"),
        "offside_line", "play_state", "stream_batch_id",
    )


def offside_line(spark: SparkSession, folder: str, k: int = 1) -> DataFrame:
    rows = gold.active(_filled(spark, folder))
    return gold.offside_lines(rows, k)


def offside_line_deepest(spark: SparkSession, folder: str) -> DataFrame:
    return offside_line(spark, folder, 0)


def play_state(spark: SparkSession, folder: str) -> DataFrame:
    return _grouped(spark, folder).groupBy("match_id", "game_section", "team_id").agg(
        F.count_if(F.col("play_state") == "active").alias("active_frames"),
        F.count_if(F.col("play_state") == "interruption").alias("interruption_frames"),
    )


def possession_frames(spark: SparkSession, folder: str) -> DataFrame:
    return grouped.possession_frames(_grouped(spark, folder))


# --- gold ---------------------------------------------------------------------------------
def frame_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(spark, folder)


def possession_islands(spark: SparkSession, folder: str) -> DataFrame:
    return gold.possession_runs(_summary(spark, folder)).select(
        "match_id", "game_section", "team_id", "run_start", "run_end", "num_frames"
    )


def possession_islands_rank(spark: SparkSession, folder: str) -> DataFrame:
    return grouped.possession_runs(possession_frames(spark, folder)).select(
        "match_id", "game_section", "team_id", "run_start", "run_end", "num_frames"
    )


def gold_possessions(spark: SparkSession, folder: str) -> DataFrame:
    return gold.gold_possessions(_filled(spark, folder), rounded=False)


def gold_possessions_stream(spark: SparkSession, folder: str) -> DataFrame:
    result = grouped.gold_stream_possessions(_grouped(spark, folder), batch_id=0, rounded=False)
    return result.select(
        *[c for c in result.columns if not c.endswith("_metrics")],
        F.col("team_metrics.avg_ball_speed").alias("avg_ball_speed"),
        F.col("team_metrics.avg_offside_line").alias("avg_offside_line"),
        F.col("opponent_metrics.avg_offside_line").alias("opponent_avg_offside_line"),
    )


def possession_clock(spark: SparkSession, folder: str) -> DataFrame:
    """Frames of possession so far per half, from the batch sequences that have a team."""
    runs = gold.possession_runs(_summary(spark, folder)).filter(F.col("team_id").isNotNull())
    return grouped.with_ordinals(runs).select(
        "match_id", "game_section", "team_id", "run_start", "possession_id", "cumulative_frames"
    )


def clipped_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """Sequences of batches of fifty frames each."""
    keys = ["match_id", "game_section", "batch_id"]
    held = possession_frames(spark, folder).withColumn("batch_id", F.floor(F.col("frame_id") / 50))
    runs = value_runs(
        held, keys, "frame_id", "team_id", grouped.sequence_partials(), grouped.sequence_merges()
    )
    return grouped.with_clipped(runs, keys).select(
        *keys, "team_id", "run_start", "run_end", "num_frames", "sequence_clipped"
    )


# --- quality ----------------------------------------------------------------------------------
def audit_direction(spark: SparkSession, folder: str) -> DataFrame:
    return quality.unresolved_directions(_bronze(spark, folder))


def audit_unknown_match(spark: SparkSession, folder: str) -> DataFrame:
    return quality.unknown_matches(tracking(spark, folder), match_info(spark, 2))


def audit_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Frames with a third team and repeated row keys, counted."""
    rows = _known(spark, folder)
    extra = quality.frames_with_extra_teams(rows).agg(F.count(F.lit(1)).alias("found"))
    repeated = quality.repeated_rows(rows).agg(F.count(F.lit(1)).alias("found"))
    return extra.select(F.lit("extra_teams").alias("check_name"), "found").unionByName(
        repeated.select(F.lit("repeated_rows").alias("check_name"), "found")
    )


def malformed_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Speeds written as ``v12.0``: none of them is a number."""
    rows = raw_tracking(spark, folder).withColumn("speed", F.concat(F.lit("v"), F.col("speed").cast("string")))
    return quality.malformed_numbers(rows.select(raw.as_entity(rows).alias("entity")))


def batch_stream_alignment(spark: SparkSession, folder: str) -> DataFrame:
    columns = [c for c in schemas.SILVER_STREAM_COLUMNS if c not in schemas.ROW_KEYS]
    return quality.alignment(
        _silver(spark, folder), _silver_stream(spark, folder), [*schemas.FRAME_KEYS, "team_id", "person_id"], columns
    )


# --- events and match documents -------------------------------------------------------------------
def flatten_event_details(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON messages: errors carry their player inside ``Play``, the others at the top."""
    table = spark.read.parquet(f"{folder}/events.parquet")
    player, distance = F.col("user_id").cast("string"), F.col("value").cast("string")
    nested = F.col("event_type") == "error"
    play = F.when(
        nested,
        F.struct(
            player.alias("Player"), distance.alias("Distance"),
            F.struct(F.col("event_type").alias("Direction")).alias("Pass"),
        ),
    )
    details = F.struct(
        F.when(~nested, player).alias("Player"),
        F.when(~nested, distance).alias("Distance"),
        F.col("event_type").alias("Type"),
        play.alias("Play"),
    )
    body = F.struct(F.col("event_id").cast("string").alias("EventId"), details.alias("EventDetails"))
    topic = table.select(
        F.to_json(body).alias("value"), F.col("ts").alias("timestamp"), F.lit("events").alias("topic")
    )
    flat = events.flattened_events(messages.event_messages(topic, "events"))
    return flat.select(
        F.col("EventId").alias("event_id"),
        F.col("EventDetails.Player").alias("player"),
        F.col("EventDetails.Distance").cast("double").alias("distance"),
        F.col("EventDetails.PassDirection").alias("pass_direction"),
        F.col("EventDetails.Type").alias("type"),
        F.col("EventDetails.xG").alias("xg"),
    )


def _xml_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One match information document per match of the view, as XML text.

    Every fifth slot of a team is a goalkeeper; those with slot 5 start the match.
    """
    people = (
        tracking(spark, folder)
        .filter(~F.col("team_id").isin(schemas.BALL, schemas.REFEREE))
        .select("match_id", "team_id", "person_id")
        .distinct()
    )
    slot = F.split("person_id", "-")[1].cast("int")
    player = F.struct(
        F.col("person_id").alias("_PersonId"),
        F.when(slot % 5 == 0, "TW").otherwise("MIT").alias("_PlayingPosition"),
        (slot == 5).cast("string").alias("_Starting"),
    )
    teams = people.groupBy("match_id", "team_id").agg(F.array_sort(F.collect_list(player)).alias("players"))
    team = F.struct(
        F.col("team_id").alias("_TeamId"), F.struct(F.col("players").alias("Player")).alias("Players")
    )
    squads = teams.groupBy("match_id").agg(F.array_sort(F.collect_list(team)).alias("teams"))
    general = F.struct(
        F.col("match_id").alias("_MatchId"), F.col("home_team_id").alias("_HomeTeamId"),
        F.col("guest_team_id").alias("_GuestTeamId"),
    )
    pitch = F.struct(
        F.col("pitch_x").cast("string").alias("_PitchX"), F.col("pitch_y").cast("string").alias("_PitchY")
    )
    document = F.struct(
        general.alias("General"), pitch.alias("Environment"), F.struct(F.col("teams").alias("Team")).alias("Teams")
    )
    text = F.to_xml(document, {"rowTag": "MatchInformation"})
    rows = squads.join(match_info(spark), "match_id").select(text.alias("text"), F.col("match_id").alias("source_file"))
    parsed = F.from_xml("text", schemas.MATCH_INFORMATION_XML, {"rowTag": "MatchInformation"})
    return rows.select(parsed.alias("document"), "source_file").select("document.*", "source_file")


def match_info_xml(spark: SparkSession, folder: str) -> DataFrame:
    return info_source.match_info(_xml_documents(spark, folder))


def goalkeepers(spark: SparkSession, folder: str) -> DataFrame:
    return info_source.goalkeepers(info_source.parsed_documents(_xml_documents(spark, folder)))


# --- measures on silver ------------------------------------------------------------------------------
def lagged_ball_distance(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.ball_distance(_known(spark, folder)).withColumn("ball_distance", F.round("ball_distance", 3))
    return shape.with_lags(rows).select(*ROW, "ball_distance", "prev_ball_distance")


def pitch_zones(spark: SparkSession, folder: str) -> DataFrame:
    zones = shape.with_zones(_known(spark, folder))
    return zones.groupBy("match_id", "game_section", "team_id", "pitch_zone").agg(F.count(F.lit(1)).alias("positions"))


def possession_zones(spark: SparkSession, folder: str) -> DataFrame:
    return shape.possession_zones(_known(spark, folder))


def _flagged(spark: SparkSession, folder: str) -> DataFrame:
    """The keeper of each team is its player with slot 0."""
    keeper = match_info(spark).select(F.explode(F.array("home_team_id", "guest_team_id")).alias("team_id"))
    keeper = keeper.withColumn(
        "goalkeeper_id", F.concat(F.split("team_id", "-")[0], F.lit("-0"))
    )
    return shape.with_goalkeeper_flag(_known(spark, folder), keeper)


def team_shape(spark: SparkSession, folder: str) -> DataFrame:
    return shape.team_shape(_flagged(spark, folder))


def team_state(spark: SparkSession, folder: str) -> DataFrame:
    states = shape.team_state(shape.team_shape(_flagged(spark, folder)))
    return states.groupBy("match_id", "game_section", "team_id", "team_state").agg(F.count(F.lit(1)).alias("frames"))


def motion_state(spark: SparkSession, folder: str) -> DataFrame:
    return shape.motion_state(_known(spark, folder))


def penalty_area(spark: SparkSession, folder: str) -> DataFrame:
    return shape.penalty_area_presence(_known(spark, folder))


def close_to_ball(spark: SparkSession, folder: str) -> DataFrame:
    near = shape.close_to_ball(frames.ball_distance(_known(spark, folder)))
    return near.select(*ROW, F.round("ball_distance", 3).alias("ball_distance"))


# --- the same run operator on another table --------------------------------------------------------------
def events_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of one event type in each user's stream of events."""
    table = spark.read.parquet(f"{folder}/events.parquet").select("user_id", "event_id", "event_type", "value")
    partials = {"events": F.count(F.lit(1)), "largest": F.max("value")}
    merges = {"events": F.sum("events"), "largest": F.max("largest")}
    return value_runs(table, ["user_id"], "event_id", "event_type", partials, merges)


_PLAIN = (
    raw_explode_project, raw_from_json, event_properties, message_round_trip,
    kickoff_frames, attack_direction, attack_direction_earliest, possession_team,
    bronze_positions, bronze_positions_stream, constant_direction,
    frame_fill_down, target_distance, ball_distance, ball_distance_norm, ball_carrier,
    opponent_pairs, nearest_opponent, nearest_opponent_crowded, silver_positions, silver_positions_stream,
    grouped_frames, offside_line, offside_line_deepest, play_state, possession_frames,
    frame_summary, possession_islands, possession_islands_rank,
    gold_possessions, gold_possessions_stream, possession_clock, clipped_sequences,
    audit_direction, audit_unknown_match, audit_rows, malformed_numbers, batch_stream_alignment,
    flatten_event_details, match_info_xml, goalkeepers,
    lagged_ball_distance, pitch_zones, possession_zones, team_shape, team_state, motion_state,
    penalty_area, close_to_ball, events_runs,
)


def _tuned(query):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(tune(spark), folder)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def all_queries():
    return {query.__name__: _tuned(query) for query in (*_PLAIN, *feeds.QUERIES, *streams.QUERIES)}
