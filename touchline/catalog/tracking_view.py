"""Tracking rows derived from the ``orders`` and ``lineitem`` tables.

Eighteen consecutive order keys make a frame of three matches: the six orders of a match are its ball, with the place of the dearest of
them, and the lines of all of them the players and referees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERS_PER_FRAME = 18
ORDERS_PER_POSSESSION = 144


def _frame(order_key: str) -> Column:
    return F.floor(F.col(order_key) / ORDERS_PER_FRAME)


def _hundredths(value: str) -> Column:
    return F.floor(F.col(value) * 100 + 0.5)


def _x(hundredths: Column) -> Column:
    return hundredths % 10501 - 5250


def _y(hundredths: Column) -> Column:
    return F.floor(hundredths / 7) % 6801 - 3400


def _half_start(orders: DataFrame) -> DataFrame:
    last_frame = F.floor(F.max("o_orderkey") / ORDERS_PER_FRAME)
    return orders.agg(F.floor((last_frame + 1) / 2).alias("half"))


def _players(lines: DataFrame) -> DataFrame:
    """One row per player and frame. Hashed by frame first: the join that follows needs no more."""
    flag = F.col("l_returnflag")
    in_team = flag.isin("A", "R")
    entity = lines.select(
        (F.col("l_orderkey") % 3).alias("m"),
        _frame("l_orderkey").alias("f"),
        F.when(flag == "A", "HOME").when(flag == "R", "GUEST").otherwise("referee").alias("role"),
        F.when(in_team, F.col("l_suppkey") % 11).otherwise(0).alias("slot"),
        F.when(F.col("l_quantity") != 50, _hundredths("l_extendedprice")).alias("c"),
        F.floor("l_quantity").alias("q"),
    )
    return entity.repartition("m", "f").groupBy("m", "f", "role", "slot").agg(
        F.max(_x(F.col("c"))).alias("xc"), F.max(_y(F.col("c"))).alias("yc"), F.max("q").alias("q")
    )


def _balls(orders: DataFrame) -> DataFrame:
    """One ball per match and frame from all of its orders; it is in play if one of them has the lowest priority."""
    price = _hundredths("o_totalprice")
    entity = orders.select(
        (F.col("o_orderkey") % 3).alias("m"), _frame("o_orderkey").alias("f"), price.alias("c"), (F.floor("o_totalprice") % 30).alias("q"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
    )
    ball = entity.groupBy("m", "f").agg(F.max("c").alias("c"), F.max("q").alias("q"), F.max("priority").alias("priority"))
    return ball.select(
        "m", "f", F.lit("BALL").alias("role"), F.lit(0).cast("bigint").alias("slot"), _x(F.col("c")).alias("xc"), _y(F.col("c")).alias("yc"), "q",
        F.when(F.col("priority") < 5, 0).otherwise(1).alias("ball_status"),
    )


def _possessions(orders: DataFrame) -> DataFrame:
    """Possession code of each match for eight frames at a time: the status that most of their orders have, ties to the home team."""
    status = F.col("o_orderstatus")
    count = orders.groupBy((F.col("o_orderkey") % 3).alias("m"), F.floor(F.col("o_orderkey") / ORDERS_PER_POSSESSION).alias("phase")).agg(
        *[F.count_if(status == code).alias(code) for code in "FOP"]
    )
    home, guest = (F.col("F") >= F.col("O")) & (F.col("F") >= F.col("P")), F.col("O") >= F.col("P")
    return count.select("m", "phase", F.when(home, 1).when(guest, 2).otherwise(0).alias("poss"))


def tracking(spark: SparkSession, folder: str) -> DataFrame:
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    balls = (
        _balls(orders)
        .withColumn("phase", F.floor(F.col("f") / 8))
        .join(_possessions(orders), ["m", "phase"])
        .drop("phase")
    )
    # A hash per partition over the frames' states; never a broadcast, whose side would grow with the data.
    states = balls.select("m", "f", "poss", "ball_status").hint("shuffle_hash")
    rows = _players(lines).join(states, ["m", "f"]).unionByName(balls)
    half = _half_start(orders).scalar()
    match, team, first_half = F.col("m").cast("string"), F.col("role"), F.col("f") < half
    return rows.select(
        F.concat(F.lit("M"), match).alias("match_id"),
        F.when(first_half, "firstHalf").otherwise("secondHalf").alias("game_section"),
        F.when(first_half, F.col("f") + 10000).otherwise(F.col("f") - half + 100000).alias("frame_id"),
        F.when(team.isin("HOME", "GUEST"), F.concat(team, F.lit("-"), match)).otherwise(team).alias("team_id"),
        F.when(team != "referee", F.concat(team, F.lit("-"), F.col("slot").cast("string"))).alias("person_id"),
        (F.col("xc") / F.lit(100.0)).alias("x"),
        (F.col("yc") / F.lit(100.0)).alias("y"),
        F.col("q").cast("double").alias("speed"),
        F.col("poss").alias("ball_possession_code"),
        F.col("ball_status"),
    )


def raw_tracking(spark: SparkSession, folder: str) -> DataFrame:
    """The view with every column of the raw contract."""
    ball, speed = F.col("team_id") == "BALL", F.col("speed")
    return tracking(spark, folder).select(
        "match_id", "game_section", "frame_id", "team_id", "person_id",
        F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("frame_id") * 40).alias("timestamp"),
        "x", "y",
        F.when(ball, speed / 8).alias("z"),
        (speed * 4).alias("distance"),
        "speed",
        ((speed - 12) / 4).alias("acceleration"),
        F.when(F.col("x").isNull(), 0).otherwise(1).alias("m_flag"),
        F.col("ball_possession_code").alias("ball_possession"),
        "ball_status",
    )


def match_info(spark: SparkSession, matches: int = 3) -> DataFrame:
    """Metadata of the first ``matches`` matches of the view."""
    match = F.col("id").cast("string")
    return spark.range(matches).select(
        F.concat(F.lit("M"), match).alias("match_id"),
        F.lit(105.0).alias("pitch_x"),
        F.lit(68.0).alias("pitch_y"),
        F.concat(F.lit("HOME-"), match).alias("home_team_id"),
        F.concat(F.lit("GUEST-"), match).alias("guest_team_id"),
    )
