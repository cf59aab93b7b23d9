"""Fixed schemas and column contracts of every dataset."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _struct(*fields) -> T.StructType:
    return T.StructType(list(fields))


def _array(name: str, element: T.StructType) -> T.StructField:
    return T.StructField(name, T.ArrayType(element))


BALL = "BALL"
REFEREE = "referee"

# Each half counts its frames by itself: one longer than the gap between the first frames of both has numbers of the next.
FRAME_KEYS = ("match_id", "game_section", "frame_id")
ROW_KEYS = ("match_id", "frame_id", "team_id", "person_id")

# --- messages (every leaf is text) -------------------------------------------
FRAME_SET = _struct(*_strings("GameSection", "MatchId", "PersonId", "TeamId"))
ENTITY_MESSAGE = _struct(
    T.StructField(
        "Frame",
        _struct(*_strings("A", "D", "M", "N", "S", "T", "X", "Y", "Z", "BallPossession", "BallStatus")),
    ),
    T.StructField("FrameSet", FRAME_SET),
)
TIME_MAJOR_RECORD = _struct(T.StructField("n", T.LongType()), _array("frames", ENTITY_MESSAGE))

# Field names of the match event feed.
PLAY_FIELDS = (
    "BallPossessionPhase", "Distance", "Evaluation", "FlatCross", "FromOpenPlay", "Height", "PenaltyBox",
    "PlayAngle", "PlayOrigin", "Player", "Recipient", "SemiField", "Team",
)
PASS_FIELDS = ("Direction", "FreeKickLayup")
EVENT_ONLY_FIELDS = (
    "AfterFreeKick", "AmountOfDefenders", "AngleToGoal", "AssistAction", "AssistShotAtGoal",
    "AssistTypeShotAtGoal", "BuildUp", "ChanceEvaluation", "CounterAttack", "Cross", "DecisionTimestamp",
    "DefensiveClearance", "DistanceToGoal", "DribbleEvaluation", "DribblingSide", "DribblingType",
    "ExecutionMode", "ExtendedTypeOfShot", "FoulType", "Fouled", "Fouler", "GameSection",
    "GoalDistanceGoalkeeper", "GoalKeeperAction", "GoalKeeperInvolved", "InsideBox", "Loser", "LoserRole",
    "LoserTeam", "PlayerSpeed", "PossessionChange", "Pressure", "Rotation", "SetupOrigin", "ShotCondition",
    "ShotOrigin", "ShotWide", "Side", "SignificanceEvaluation", "SuccessfulShot", "TakerBallControl",
    "TakerSetup", "TeamFouled", "TeamFouler", "TeamLeft", "TeamRight", "Type", "TypeOfShot", "Winner",
    "WinnerAction", "WinnerResult", "WinnerRole", "WinnerTeam", "xG",
)
EVENT_HEADER_FIELDS = (
    "EventId", "EventTime", "EventType", "MatchId",
    "X-Position", "X-Source-Position", "Y-Position", "Y-Source-Position",
)

_PASS = T.StructField("Pass", _struct(*_strings(*PASS_FIELDS)))
EVENT_MESSAGE = _struct(
    T.StructField(
        "EventDetails",
        _struct(
            *_strings(*PLAY_FIELDS, *EVENT_ONLY_FIELDS),
            _PASS,
            T.StructField("Play", _struct(*_strings(*PLAY_FIELDS), _PASS)),
        ),
    ),
    *_strings(*EVENT_HEADER_FIELDS),
)

# Attribute names of the match information document.
GENERAL_FIELDS = (
    "CompetitionId", "CompetitionName", "DlProviderId", "GuestTeamId", "GuestTeamName", "HomeTeamId",
    "HomeTeamName", "Host", "KickoffTime", "MatchDay", "MatchId", "MatchTitle", "PlannedKickoffTime",
    "Result", "Season", "SeasonId", "Type", "TypeOfSport",
)
ENVIRONMENT_FIELDS = (
    "AirHumidity", "AirPressure", "Country", "Floodlight", "NeutralVenue", "NumberOfSpectators",
    "PitchErosion", "PitchX", "PitchY", "Precipitation", "Roof", "SoldOut", "StadiumAddress",
    "StadiumCapacity", "StadiumId", "StadiumName", "Temperature",
)
PLAYING_TIME_FIELDS = ("PlayingTimeFirstHalf", "PlayingTimeSecondHalf", "TotalTimeFirstHalf", "TotalTimeSecondHalf")
PLAYER_FIELDS = (
    "FirstName", "LastName", "PersonId", "PlayingPosition", "ShirtNumber", "Shortname", "Starting", "TeamLeader",
)
STAFF_FIELDS = ("FirstName", "LastName", "PersonId", "Role", "Shortname")
TEAM_FIELDS = (
    "LineUp", "PlayerShirtMainColor", "PlayerShirtNumberColor", "PlayerShirtSecondaryColor", "PlayerShirtType",
    "Role", "TeamId", "TeamName",
)

_STAFF = _struct(*_strings(*STAFF_FIELDS))
MATCH_INFORMATION = _struct(
    T.StructField("Environment", _struct(*_strings(*ENVIRONMENT_FIELDS))),
    T.StructField("General", _struct(*_strings(*GENERAL_FIELDS))),
    T.StructField("OtherGameInformation", _struct(*_strings(*PLAYING_TIME_FIELDS))),
    _array("Referees", _STAFF),
    _array(
        "Teams",
        _struct(
            *_strings(*TEAM_FIELDS),
            _array("Players", _struct(*_strings(*PLAYER_FIELDS))),
            _array("TrainerStaff", _STAFF),
        ),
    ),
)


def _attributes(names) -> list[T.StructField]:
    return _strings(*[f"_{name}" for name in names])


# The same document as the XML reader sees it: attributes carry a leading underscore.
MATCH_INFORMATION_XML = _struct(
    T.StructField("Environment", _struct(*_attributes(ENVIRONMENT_FIELDS))),
    T.StructField("General", _struct(*_attributes(GENERAL_FIELDS))),
    T.StructField("OtherGameInformation", _struct(*_attributes(PLAYING_TIME_FIELDS))),
    T.StructField("Referees", _struct(_array("Referee", _struct(*_attributes(STAFF_FIELDS))))),
    T.StructField(
        "Teams",
        _struct(
            _array(
                "Team",
                _struct(
                    *_attributes(TEAM_FIELDS),
                    T.StructField("Players", _struct(_array("Player", _struct(*_attributes(PLAYER_FIELDS))))),
                    T.StructField("TrainerStaff", _struct(_array("Trainer", _struct(*_attributes(STAFF_FIELDS))))),
                ),
            )
        ),
    ),
)

# --- tables ------------------------------------------------------------------
_ID = _strings("match_id", "game_section")


def _doubles(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.DoubleType()) for name in names]


def _ints(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.IntegerType()) for name in names]


RAW_POSITIONS = _struct(
    *_ID, T.StructField("frame_id", T.LongType()), *_strings("team_id", "person_id"),
    T.StructField("timestamp", T.TimestampType()),
    *_doubles("x", "y", "z", "distance", "speed", "acceleration"),
    *_ints("m_flag", "ball_possession", "ball_status"),
)
MATCH_INFO = _struct(
    *_strings("match_id"), *_doubles("pitch_x", "pitch_y"), *_strings("home_team_id", "guest_team_id")
)
BRONZE_POSITIONS = _struct(
    *[T.StructField(f.name, T.StringType() if f.name == "ball_possession" else f.dataType) for f in RAW_POSITIONS],
    *_ints("attack_direction"), *_doubles("x_norm", "y_norm"),
)
BRONZE_STREAM_POSITIONS = _struct(
    *[
        T.StructField(f.name, T.StringType()) if f.name == "timestamp" else f
        for f in BRONZE_POSITIONS if f.name != "z"
    ]
)
SILVER_POSITIONS = _struct(
    *_ID, T.StructField("frame_id", T.LongType()), *_strings("team_id", "person_id"),
    *_doubles("x", "y", "x_norm", "y_norm", "distance", "speed", "acceleration"),
    *_strings("ball_possession"), *_ints("ball_status"), *_doubles("ball_distance"),
    T.StructField("has_possession", T.BooleanType()), *_strings("pair_player_id"),
    *_doubles("pair_player_distance", "closest_opponent_distance", "target_distance"),
)
SILVER_STREAM_POSITIONS = _struct(*[f for f in SILVER_POSITIONS if f.name not in ("x", "y")])

RAW_COLUMNS = RAW_POSITIONS.names
BRONZE_COLUMNS = BRONZE_POSITIONS.names
BRONZE_STREAM_COLUMNS = BRONZE_STREAM_POSITIONS.names
SILVER_COLUMNS = SILVER_POSITIONS.names
SILVER_STREAM_COLUMNS = SILVER_STREAM_POSITIONS.names

GROUPED_PLAYER_COLUMNS = [
    "person_id", "speed", "distance", "acceleration", "x_norm", "y_norm", "ball_possession", "ball_status",
    "ball_distance", "has_possession", "pair_player_id", "pair_player_distance",
    "closest_opponent_distance", "target_distance",
]
GROUPED_COLUMNS = ["match_id", "team_id", "frame_id", "game_section", "players", "offside_line", "play_state"]
GOLD_COLUMNS = [
    "match_id", "game_section", "team_id", "opponent_id", "possession_id", "duration_sec",
    "avg_ball_speed", "avg_offside_line", "opponent_avg_offside_line",
]
GOLD_STREAM_COLUMNS = [
    "possession_id", "match_id", "game_section", "cumulative_time", "team_id", "opponent_id", "start_frame",
    "end_frame", "num_frames", "duration_sec", "duration_min", "active_frames", "interruption_frames",
    "team_metrics", "opponent_metrics", "stream_batch_id", "sequence_clipped",
]
