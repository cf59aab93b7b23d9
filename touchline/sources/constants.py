"""Fixed values, as small dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Match, home team (possession code 1), guest team (possession code 2).
POSSESSION_SLOTS = [
    ("DFL-MAT-J03WMX", "DFL-CLU-000008", "DFL-CLU-00000G"),
    ("DFL-MAT-J03WN1", "DFL-CLU-00000S", "DFL-CLU-00000B"),
    ("DFL-MAT-J03WOH", "DFL-CLU-00000P", "DFL-CLU-000011"),
    ("DFL-MAT-J03WOY", "DFL-CLU-00000P", "DFL-CLU-00000Q"),
    ("DFL-MAT-J03WPY", "DFL-CLU-00000P", "DFL-CLU-000005"),
    ("DFL-MAT-J03WQQ", "DFL-CLU-00000P", "DFL-CLU-00000H"),
    ("DFL-MAT-J03WR9", "DFL-CLU-00000P", "DFL-CLU-00000I"),
]

# Match, team, direction of attack in the first half (+1 to the right).
FIRST_HALF_DIRECTIONS = [
    ("DFL-MAT-J03WMX", "DFL-CLU-000008", -1),
    ("DFL-MAT-J03WMX", "DFL-CLU-00000G", 1),
    ("DFL-MAT-J03WN1", "DFL-CLU-00000B", 1),
    ("DFL-MAT-J03WN1", "DFL-CLU-00000S", -1),
    ("DFL-MAT-J03WOH", "DFL-CLU-00000P", -1),
    ("DFL-MAT-J03WOH", "DFL-CLU-000011", 1),
    ("DFL-MAT-J03WOY", "DFL-CLU-00000P", -1),
    ("DFL-MAT-J03WOY", "DFL-CLU-00000Q", 1),
    ("DFL-MAT-J03WPY", "DFL-CLU-000005", 1),
    ("DFL-MAT-J03WPY", "DFL-CLU-00000P", -1),
    ("DFL-MAT-J03WQQ", "DFL-CLU-00000H", 1),
    ("DFL-MAT-J03WQQ", "DFL-CLU-00000P", -1),
    ("DFL-MAT-J03WR9", "DFL-CLU-00000I", -1),
    ("DFL-MAT-J03WR9", "DFL-CLU-00000P", 1),
]

# Match, first frame of its second half.
HALF_START_FRAMES = [("DFL-MAT-J03WMX", 100000)]

# Team, goalkeeper used when no match document names one.
FALLBACK_GOALKEEPERS = [
    ("DFL-CLU-000008", "DFL-OBJ-0002HE"),
    ("DFL-CLU-00000G", "DFL-OBJ-0002DR"),
]

# Frame rate, pitch, target points, kickoff frames and thresholds.
FRAMES_PER_SECOND = 25
PITCH_X = 105.0
PITCH_Y = 68.0
BATCH_TARGET_POINT = (105.0, 34.0)
STREAM_TARGET_POINT = (52.5, 34.0)
KICKOFF_FRAMES = (10000, 100000)
OFFSIDE_LINE_INDEX = 1
FRAME_GAP_RESET = 1000
PENALTY_AREA = {"x_min": 88.5, "x_max": 105.0, "y_min": 13.84, "y_max": 54.16}
CLOSE_BALL_DISTANCE = 2.0
OFFSIDE_LINE_PERCENT = 33.33
HEIGHT_SPAN_PERCENT = 50.0
TRIGGER_INTERVAL = "30 seconds"


def known_matches(spark: SparkSession) -> DataFrame:
    """Match info of the built-in matches, with the default pitch."""
    rows = [(match, PITCH_X, PITCH_Y, home, guest) for match, home, guest in POSSESSION_SLOTS]
    return spark.createDataFrame(
        rows, "match_id string, pitch_x double, pitch_y double, home_team_id string, guest_team_id string"
    )


def first_half_directions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        FIRST_HALF_DIRECTIONS, "match_id string, team_id string, first_half_direction int"
    )


def half_start_frames(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(HALF_START_FRAMES, "match_id string, half_start_frame bigint")


def fallback_goalkeepers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FALLBACK_GOALKEEPERS, "team_id string, goalkeeper_id string")
