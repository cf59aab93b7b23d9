from touchline import schemas
from touchline.plans import bronze
from touchline.sources import constants

RAW = (
    "match_id string, game_section string, frame_id bigint, team_id string, person_id string, timestamp timestamp, "
    "x double, y double, z double, distance double, speed double, acceleration double, m_flag int, "
    "ball_possession int, ball_status int"
)
INFO = "match_id string, pitch_x double, pitch_y double, home_team_id string, guest_team_id string"


def _row(match, section, frame, team, person, x, y, code=1):
    return (match, section, frame, team, person, None, x, y, None, 0.0, 0.0, 0.0, 1, code, 1)


def _match():
    rows = []
    for section, frame, side in (("firstHalf", 10000, 1), ("secondHalf", 100000, -1)):
        for n in (frame, frame + 1):
            rows += [
                _row("M", section, n, "H", "h1", -50.0 * side, 10.0),
                _row("M", section, n, "H", "h2", 5.0 * side, -10.0),
                _row("M", section, n, "G", "g1", 48.0 * side, 0.0),
                _row("M", section, n, "G", "g2", -2.0 * side, None),
                _row("M", section, n, "BALL", "b", 1.0, 2.0),
                _row("M", section, n, "referee", None, 3.0, 4.0),
            ]
    return rows


def _by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_batch_bronze(spark):
    rows = spark.createDataFrame(_match(), RAW)
    info = spark.createDataFrame([("M", 105.0, 68.0, "H", "G"), ("M", 105.0, 68.0, "H", "G")], INFO)
    result = bronze.bronze_positions(rows, info)
    assert result.columns == schemas.BRONZE_COLUMNS and result.count() == len(_match())
    got = _by(result, "frame_id", "team_id", "person_id")
    assert got[10000, "H", "h1"].attack_direction == 1 and got[100001, "H", "h1"].attack_direction == -1
    assert got[10000, "G", "g1"].attack_direction == -1
    assert (got[10000, "H", "h1"].x_norm, got[10000, "H", "h1"].y_norm) == (2.5, 24.0)
    assert (got[10000, "G", "g1"].x_norm, got[10000, "G", "g1"].y_norm) == (4.5, 34.0)
    assert got[10000, "G", "g2"].y_norm is None
    assert got[10000, "BALL", "b"].attack_direction == 1 and got[100000, "BALL", "b"].attack_direction == -1
    assert got[10000, "referee", None].attack_direction is None
    assert got[10000, "referee", None].x_norm == 105.0 - (3.0 + 52.5)
    assert {r.ball_possession for r in got.values()} == {"H"}


def test_stream_bronze_gives_every_row_a_direction(spark):
    rows = spark.createDataFrame(_match(), RAW).withColumnRenamed("ball_possession", "ball_possession_code")
    rows = rows.withColumn("timestamp", rows.timestamp.cast("string")).filter("frame_id not in (10000, 100000)")
    info = spark.createDataFrame([("M", 105.0, 68.0, "H", "G")], INFO)
    result = bronze.bronze_stream_positions(rows, info)
    assert result.columns == schemas.BRONZE_STREAM_COLUMNS
    got = _by(result, "frame_id", "team_id", "person_id")
    assert got[10001, "referee", None].attack_direction == 1
    assert got[100001, "H", "h2"].attack_direction == -1


def test_unknown_match(spark):
    rows = spark.createDataFrame(_match(), RAW)
    nobody = spark.createDataFrame([], INFO)
    batch = bronze.bronze_positions(rows, nobody).collect()
    assert all(r.x_norm is None and r.ball_possession is None for r in batch)
    renamed = rows.withColumnRenamed("ball_possession", "ball_possession_code")
    stream = _by(bronze.bronze_stream_positions(renamed, nobody), "frame_id", "team_id", "person_id")
    assert stream[10000, "H", "h1"].x_norm == 2.5 and stream[10000, "BALL", "b"].attack_direction is None


def test_direction_ties_and_missing_positions_count_as_minus_one(spark):
    rows = [
        _row("M", "firstHalf", 10000, "H", "a", -7.0, 0.0), _row("M", "firstHalf", 10000, "H", "b", 7.0, 0.0),
        _row("M", "firstHalf", 10000, "G", "c", None, 0.0), _row("M", "firstHalf", 10001, "I", "d", -7.0, 0.0),
    ]
    got = bronze.kickoff_directions(spark.createDataFrame(rows, RAW)).collect()
    assert {r.team_id: r.attack_direction for r in got} == {"H": -1, "G": -1}


def test_large_lookup_tables_are_not_broadcast(spark):
    from touchline.operators.lookup import bounded

    table = spark.range(100).selectExpr("id", "id * 2 as twice")
    rows = spark.range(1000)
    small = rows.join(bounded(table, 100), "id", "left")._jdf.queryExecution().toString()
    assert "strategy=broadcast" in small.split("== Analyzed")[0]
    large = rows.join(bounded(table, 99), "id", "left")._jdf.queryExecution().toString()
    assert "strategy=broadcast" not in large.split("== Analyzed")[0]


def test_constant_directions_turn_at_half_time(spark):
    match, team, first = constants.FIRST_HALF_DIRECTIONS[0]
    rows = [_row(match, "firstHalf", 10000, team, "p", 0.0, 0.0), _row(match, "secondHalf", 100000, team, "p", 0.0, 0.0)]
    got = bronze.constant_directions(
        spark.createDataFrame(rows, RAW), constants.first_half_directions(spark), constants.half_start_frames(spark)
    )
    assert {r.frame_id: r.attack_direction for r in got.collect()} == {10000: first, 100000: -first}
