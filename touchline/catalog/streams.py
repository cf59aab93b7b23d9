"""Streaming queries: the view as files of messages, read by a checkpointed stream."""

from __future__ import annotations

import contextlib
import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.catalog.tables import raw_rows, raw_table, work_folder
from touchline.catalog.tracking_view import match_info
from touchline.operators import frames
from touchline.plans import bronze, raw, silver
from touchline.sources import messages, sinks
from touchline.streaming import lags, levels, mirror, possessions

TOPIC = "positions"


def _staged(rows: DataFrame, folder: str) -> str:
    """Messages by ``part``, written once."""
    text = rows.withColumn("timestamp", F.unix_millis("timestamp").cast("string"))
    staged = f"{folder}/staged"
    text.select(F.to_json(raw.as_entity(text)).alias("value"), "part").write.partitionBy("part").parquet(staged)
    return staged


def _feed(spark: SparkSession, staged: str, part: int, folder: str) -> str:
    inbox = f"{folder}/inbox"
    spark.read.parquet(staged).filter(F.col("part") == part).select("value").write.mode("append").text(inbox)
    return inbox


def stream_bronze_silver_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Each half of the matches is one micro-batch of the stateless stream."""
    work = work_folder(spark)
    part = F.when(F.col("game_section") == "firstHalf", 0).otherwise(1)
    staged = _staged(raw_rows(spark, folder).withColumn("part", part), work)
    pipeline = levels.LevelPipeline(
        match_info(spark), levels.to_tables(f"{work}/out"), topic=TOPIC, emit=("silver", "gold"), audit=True
    )
    for step in range(2):
        inbox = _feed(spark, staged, step, work)
        source = messages.file_messages(spark, inbox, TOPIC, max_files=None)
        levels.start(source, pipeline, f"{work}/checkpoint", interval=None).awaitTermination()
    result = pipeline.publish.read(spark, "gold")
    return result.select(
        "match_id", "game_section", "team_id", "opponent_id", "possession_id", "cumulative_time",
        "start_frame", "end_frame", "num_frames", "active_frames", "stream_batch_id", "sequence_clipped",
    )


def _topic(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """All rows as one batch of messages."""
    staged = _staged(rows.withColumn("part", F.lit(0)), work_folder(spark))
    return spark.read.parquet(staged).select("value", F.timestamp_millis(F.lit(0)).alias("timestamp"), F.lit(TOPIC).alias("topic"))


def level_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger of a batch of which one level is published and all are built and counted."""
    pipeline = levels.LevelPipeline(match_info(spark), levels.to_tables(f"{work_folder(spark)}/out"), topic=TOPIC, emit=("grouped",))
    pipeline.process(_topic(spark, raw_rows(spark, folder)), 0)
    return pipeline.publish.ledger(spark).select("level", "rows", F.col("level").isin(*pipeline.emit).alias("published"))


def recovered_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Grouped rows of a batch that broke off after its first levels and was repeated."""
    work = work_folder(spark)
    topic = _topic(spark, raw_rows(spark, folder))
    tables = levels.to_tables(f"{work}/out")

    def breaks(level: str, rows: DataFrame, batch_id: int) -> None:
        if level == "grouped":
            raise ConnectionError("lost between two levels")
        tables(level, rows, batch_id)

    with contextlib.suppress(ConnectionError):
        levels.LevelPipeline(match_info(spark), breaks, topic=TOPIC).process(topic, 0)
    levels.LevelPipeline(match_info(spark), tables, topic=TOPIC).process(topic, 0)
    rows = tables.read(spark, "silver").groupBy("match_id", "game_section").agg(F.count("*").alias("silver_rows"))
    teams = tables.read(spark, "grouped").groupBy("match_id", "game_section").agg(F.count("*").alias("grouped_rows"))
    return rows.join(teams, ["match_id", "game_section"])


def unknown_match_modes(spark: SparkSession, folder: str) -> DataFrame:
    """A feed with a match of which nothing is known: listed by the audit, and fatal in strict mode."""
    work = work_folder(spark)
    topic, info = _topic(spark, raw_rows(spark, folder)), match_info(spark, matches=2)
    warned = levels.to_tables(f"{work}/warn")
    levels.LevelPipeline(info, warned, topic=TOPIC, build=("bronze",), audit=True).process(topic, 0)
    try:
        levels.LevelPipeline(info, levels.to_tables(f"{work}/strict"), topic=TOPIC, build=("bronze",), strict=True).process(topic, 0)
        outcome = "passed"
    except PySparkException as failure:
        outcome = re.search("no metadata for match M[0-9]+", str(failure))[0]
    listed = warned.read(spark, "unknown_matches").select(F.lit("audit").alias("mode"), F.concat(F.lit("no metadata for match "), "match_id").alias("outcome"))
    bronze_rows = warned.read(spark, "bronze").agg(F.count("*").cast("string").alias("outcome")).select(F.lit("rows").alias("mode"), "outcome")
    strict = spark.range(1).select(F.lit("strict").alias("mode"), F.lit(outcome).alias("outcome"))
    return listed.unionByName(bronze_rows).unionByName(strict)


def stream_lagged_ball_distance(spark: SparkSession, folder: str, parts: int = 3) -> DataFrame:
    """Ball distances as a stream of tables, taken up part by part, each with the player's value before it."""
    work = work_folder(spark)
    known = silver.identified(bronze.bronze_positions(raw_table(spark, folder), match_info(spark)))
    columns = ["match_id", "game_section", "frame_id", "team_id", "person_id"]
    rows = frames.ball_distance(known).select(*columns, F.round("ball_distance", 3).alias("ball_distance")).filter("person_id IS NOT NULL")
    staged = f"{work}/staged"
    cuts = rows.agg(F.percentile_approx("frame_id", [n / parts for n in range(1, parts)])).first()[0] or []
    part = sum(((F.col("frame_id") > cut).cast("int") for cut in cuts), F.lit(0))
    rows.withColumn("part", part).write.partitionBy("part").parquet(staged)
    for step in range(parts):
        spark.read.parquet(staged).filter(F.col("part") == step).drop("part").write.mode("append").parquet(f"{work}/inbox")
        source = spark.readStream.schema(rows.schema).parquet(f"{work}/inbox")
        query = possessions.start(lags.lagged_stream(source), f"{work}/out", f"{work}/checkpoint", "250 milliseconds", by=())
        try:
            possessions.await_silence(query, -1)
        finally:
            query.stop()
    return spark.read.parquet(f"{work}/out")


def arrival_order(spark: SparkSession, folder: str) -> DataFrame:
    """Messages that arrive in the order of a hash, some without a time: rows, and rows before which a later one stands in their partition."""
    rows = raw_rows(spark, folder).select(F.when(F.col("frame_id") % 9 > 0, F.pmod(F.xxhash64("match_id", "frame_id", "team_id"), F.lit(10_000))).alias("_arrival_ms"))
    placed = sinks.arrival_order(rows).select("_arrival_ms", F.monotonically_increasing_id().alias("place"), F.spark_partition_id().alias("part"))
    before = F.lag(F.coalesce("_arrival_ms", F.lit(1 << 40))).over(Window.partitionBy("part").orderBy("place"))
    return placed.withColumn("_before", before).agg(
        F.count("*").alias("messages"), F.count_if(F.col("_arrival_ms").isNull()).alias("unknown"),
        F.count_if(F.col("_before") > F.coalesce("_arrival_ms", F.lit(1 << 40))).alias("out_of_order"),
    )


def mirrored_match_information(spark: SparkSession, folder: str) -> DataFrame:
    """Match information messages, one for every supplier, appended to a raw mirror by a stream."""
    work = work_folder(spark)
    key = F.col("s_suppkey").cast("string")
    team = F.struct(F.concat(F.lit("T"), key).alias("TeamId"), F.array(F.struct(F.concat(F.lit("K"), key).alias("PersonId"))).alias("Players"))
    document = F.struct(F.struct(F.concat(F.lit("S"), key).alias("MatchId"), F.lit("1").alias("MatchDay")).alias("General"), F.array(team).alias("Teams"))
    suppliers = spark.read.parquet(f"{folder}/supplier.parquet")
    suppliers.select(F.to_json(document).alias("value")).write.text(f"{work}/inbox")
    source = messages.file_messages(spark, f"{work}/inbox", "information", max_files=None)
    mirror.mirror_match_information(source, f"{work}/out", f"{work}/checkpoint", "information", interval=None).awaitTermination()
    teams = spark.read.parquet(f"{work}/out").select("General.MatchId", "General.MatchDay", F.explode("Teams").alias("team"))
    return teams.select(F.col("MatchId").alias("match_id"), F.col("MatchDay").alias("match_day"), "team.TeamId", F.col("team.Players")[0]["PersonId"].alias("person_id")).withColumnRenamed("TeamId", "team_id")


def stream_possessions_stateful(spark: SparkSession, folder: str, parts: int = 3, idle: int = 8_000) -> DataFrame:
    """The rows in the order of frames, each part taken up by a restart of the stream; silence closes the last half."""
    work = work_folder(spark)
    rows = raw_table(spark, folder)
    # Cut at frame numbers, so the rows of a part stay in as many tasks as they are.
    shares = [n / parts for n in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("frame_id", shares)).first()[0] or []
    part = sum(((F.col("frame_id") > cut).cast("int") for cut in cuts), F.lit(0))
    staged = _staged(rows.withColumn("part", part), work)
    for step in range(parts):
        inbox = _feed(spark, staged, step, work)
        source = messages.file_messages(spark, inbox, TOPIC, max_files=None)
        emitted = possessions.possession_stream(source, match_info(spark), TOPIC, idle=idle)
        query = possessions.start(emitted, f"{work}/out", f"{work}/checkpoint", interval="250 milliseconds")
        try:
            possessions.await_silence(query, idle if step == parts - 1 else -1)
        finally:
            query.stop()
    return possessions.sequences(spark.read.parquet(f"{work}/out"), rounded=False)


QUERIES = (
    stream_bronze_silver_gold, stream_possessions_stateful, level_counts, recovered_levels, unknown_match_modes, arrival_order,
    mirrored_match_information, stream_lagged_ball_distance,
)
