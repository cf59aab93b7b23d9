"""Queries over real files: JSON lines, XML and override documents, written from the tables and read through the file sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline import schemas
from touchline.catalog.tables import raw_table, work_folder
from touchline.catalog.tracking_view import match_info
from touchline.operators import shape
from touchline.plans import bronze, gold, incremental, raw
from touchline.sources import constants, files, quarantine
from touchline.sources import match_info as info_source


def _lines(rows: DataFrame) -> DataFrame:
    """``match_id, frame_id, line``: time-major records of raw rows."""
    records = rows.groupBy("match_id", "frame_id").agg(F.collect_list(raw.as_entity(rows)).alias("frames"))
    return records.select("match_id", "frame_id", F.to_json(F.struct(F.col("frame_id").alias("n"), "frames")).alias("line"))


def _write(lines: DataFrame, path: str) -> str:
    lines.write.mode("append").text(path)
    return path


def _broken(frame: Column, line: Column) -> Column:
    """Four lines of ten are cut, emptied, of the wrong shape or no JSON at all."""
    kind = frame % 10
    return (
        F.when(kind == 0, F.expr("substring(line, 1, length(line) - 5)"))
        .when(kind == 1, F.to_json(F.struct(frame.alias("n"), F.array().cast("array<int>").alias("frames"))))
        .when(kind == 2, F.to_json(F.struct(frame.alias("n"), F.lit("none").alias("frames"))))
        .when(kind == 3, F.lit("no record"))
        .otherwise(line)
    )


def raw_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What became of each line of a feed with broken ones, and how many entities were read."""
    lines = _lines(raw_table(spark, folder)).select(_broken(F.col("frame_id"), F.col("line")))
    path = _write(lines, f"{work_folder(spark)}/records")
    split = quarantine.time_major(quarantine.text_lines(spark, path))
    good = split.good.select(F.lit("accepted").alias("reason"), F.size("frames").alias("entities"))
    both = good.unionByName(split.rejects.select("reason", F.lit(0).alias("entities")))
    return both.groupBy("reason").agg(F.count("*").alias("lines"), F.sum("entities").alias("entities"))


def message_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The same for a topic: every seventh frame's messages are cut, and of every eleventh nobody is named."""
    rows = raw_table(spark, folder)
    nobody = F.when(F.col("frame_id") % 11 == 0, F.lit(None)).otherwise(F.col("match_id"))
    named = rows.withColumn("match_id", nobody)
    whole = named.select("frame_id", F.to_json(raw.as_entity(named)).alias("line"))
    cut = F.when(F.col("frame_id") % 7 == 0, F.expr("substring(line, 1, length(line) - 2)")).otherwise(F.col("line"))
    path = _write(whole.select(cut), f"{work_folder(spark)}/topic")
    topic = spark.read.text(path).select("value", F.timestamp_millis(F.lit(0)).alias("timestamp"), F.lit("positions").alias("topic"))
    split = quarantine.entity_messages(topic, "positions")
    good = raw.message_positions(split.good).select(F.lit("accepted").alias("reason"), "frame_id")
    both = good.unionByName(split.rejects.select("reason", F.lit(None).cast("bigint").alias("frame_id")))
    return both.groupBy("reason").agg(F.count("*").alias("messages"), F.max("frame_id").alias("last_frame"))


# --- documents: one for every supplier -------------------------------------------------------------------------
_XML = """<PutDataRequest>
<MatchInformation><General MatchId="%s" HomeTeamId="H%s" GuestTeamId="G%s"/><Environment PitchX="105" PitchY="68"/>
<Teams><Team TeamId="T%s"><Players><Player PersonId="K%s" PlayingPosition="TW" Starting="true"/></Players></Team></Teams>
</MatchInformation></PutDataRequest>"""


def _one_file_each(rows: DataFrame, path: str) -> str:
    """A file for every row, all in one folder: a folder for each would have to be made, moved and listed by the driver alone.

    All tasks write, and each moves its own files (version 2 of the committer). A row's task and file name follow from its key, so a
    repeated task replaces its files.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(tasks, "supplier").sortWithinPartitions("supplier").select("value")
    dealt.write.options(**{"maxRecordsPerFile": 1, "mapreduce.fileoutputcommitter.algorithm.version": 2}).text(path)
    return path


def _documents(spark: SparkSession, folder: str) -> quarantine.Split:
    """Of seven suppliers' documents one is cut, one is malformed and one names no match."""
    suppliers = spark.read.parquet(f"{folder}/supplier.parquet").select(F.col("s_suppkey").alias("supplier"))
    kind, key = F.col("supplier") % 7, F.col("supplier").cast("string")
    whole = F.format_string(_XML, F.when(kind == 2, "").otherwise(F.concat(F.lit("S"), key)), key, key, key, key)
    text = (
        F.when(kind == 0, F.expr("substring(text, 1, length(text) - 30)")).when(kind == 1, F.replace("text", F.lit("<Teams>"), F.lit("<Teams")))
        .otherwise(F.col("text"))
    )
    rows = suppliers.withColumn("text", whole).select("supplier", text.alias("value"))
    path = _one_file_each(rows, f"{work_folder(spark)}/documents")
    return quarantine.match_documents(quarantine.text_lines(spark, path, whole=True))


def _overrides(spark: SparkSession, folder: str) -> quarantine.Split:
    """For every third supplier another pitch and home team; every fifth of these documents is broken."""
    suppliers = spark.read.parquet(f"{folder}/supplier.parquet").where("s_suppkey % 3 = 0")
    key = F.col("s_suppkey").cast("string")
    fields = F.struct(
        F.concat(F.lit("S"), key).alias("match_id"), F.concat(F.lit("O"), key).alias("home_team_id"), F.lit("V").alias("guest_team_id"),
        F.col("s_acctbal").cast("double").alias("pitch_x"),
    )
    text = F.when(F.col("s_suppkey") % 5 == 0, F.lit('{"match_id":')).otherwise(F.to_json(fields))
    path = _one_file_each(suppliers.select(F.col("s_suppkey").alias("supplier"), text.alias("value")), f"{work_folder(spark)}/overrides")
    return quarantine.match_overrides(quarantine.text_lines(spark, path, whole=True))


def document_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Reasons for which match and override documents were turned away, and the documents that were read."""
    parts = [
        split.rejects.select("source", "reason").unionByName(split.good.select(F.lit(source).alias("source"), F.lit("accepted").alias("reason")))
        for source, split in (("match_documents", _documents(spark, folder)), ("match_overrides", _overrides(spark, folder)))
    ]
    return parts[0].unionByName(parts[1]).groupBy("source", "reason").agg(F.count("*").alias("documents"))


def match_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata from XML documents, overlaid by override documents and default pitches, over the built-in matches."""
    known = info_source.one_per_match(info_source.match_info(_documents(spark, folder).good)).unionByName(constants.known_matches(spark))
    return info_source.overlay(_overrides(spark, folder).good, known)


def keepers_by_team(spark: SparkSession, folder: str) -> DataFrame:
    """Starting goalkeepers of the documents, and the built-in ones of teams without a document."""
    parsed = info_source.parsed_documents(_documents(spark, folder).good)
    return info_source.goalkeepers(parsed, constants.fallback_goalkeepers(spark))


# --- the built-in dimensions on tracking rows ------------------------------------------------------------------
def _renamed(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows under the names of the first three built-in matches and their teams."""
    number = F.row_number().over(Window.orderBy("match_id")) - 1
    names = constants.known_matches(spark).withColumn("m", F.concat(F.lit("M"), number.cast("string"))).select(
        "m", F.col("match_id").alias("known"), F.col("home_team_id").alias("home"), F.col("guest_team_id").alias("guest")
    )
    rows = raw_table(spark, folder).join(F.broadcast(names), F.col("match_id") == F.col("m"))
    team = F.when(F.col("team_id").startswith("HOME"), F.col("home")).when(F.col("team_id").startswith("GUEST"), F.col("guest"))
    return rows.withColumns({"match_id": F.col("known"), "team_id": F.coalesce(team, "team_id")}).drop("m", "known", "home", "guest")


def built_in_dimensions(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per team by the built-in directions, half starts, possession slots and fallback goalkeepers."""
    rows = bronze.with_possessing_team(bronze.with_match_info(_renamed(spark, folder), constants.known_matches(spark)))
    turned = bronze.constant_directions(rows, constants.first_half_directions(spark), constants.half_start_frames(spark))
    flagged = shape.with_goalkeeper_flag(turned, constants.fallback_goalkeepers(spark))
    return flagged.groupBy("match_id", "team_id", "attack_direction").agg(
        F.count("*").alias("positions"), F.count_if(F.col("ball_possession") == F.col("team_id")).alias("with_ball"),
        F.count_if("is_goalkeeper").alias("keepers"),
    )


# --- growing folders ---------------------------------------------------------------------------------------------
def incremental_possessions(spark: SparkSession, folder: str) -> DataFrame:
    """Records and documents that land in two steps, each taken up by itself; sequences of the tables they leave."""
    work = work_folder(spark)
    growing = incremental.Growing(f"{work}/records", f"{work}/documents", f"{work}/tables")
    lines = _lines(raw_table(spark, folder))
    later = (F.col("match_id") == "M2") | (F.col("frame_id") >= 100_000)
    document = F.concat(
        F.lit('<MatchInformation><General MatchId="'), "match_id", F.lit('" HomeTeamId="'), "home_team_id", F.lit('" GuestTeamId="'), "guest_team_id",
        F.lit('"/><Environment PitchX="105" PitchY="68"/></MatchInformation>'),
    )
    for step, matches in ((~later, F.col("match_id") != "M2"), (later, F.col("match_id") == "M2")):
        _write(lines.filter(step).select("line"), growing.records)
        _write(match_info(spark).filter(matches).select(document), growing.documents)
        incremental.advance(spark, growing)
    rows = files.stage_table(spark, growing.path("silver_positions"), schemas.SILVER_POSITIONS)
    return gold.gold_possessions(rows, rounded=False)


QUERIES = (
    raw_rejects, message_rejects, document_rejects, match_metadata, keepers_by_team, built_in_dimensions, incremental_possessions,
)
