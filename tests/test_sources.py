import json

from touchline import schemas
from touchline.operators import events, quality
from touchline.plans import incremental, pipeline, raw
from touchline.sources import constants, files, match_info, messages, quarantine, sinks


def _entity(n, team, person, x="1.5", **more):
    frame = {"N": str(n), "T": "2023-01-01T12:00:00.040Z", "X": x, "Y": "2.25", "Z": None, "D": "3", "S": "4.5", "A": "-1",
             "M": "1", "BallPossession": "1", "BallStatus": "1", **more}
    owner = {"MatchId": "7", "GameSection": "firstHalf", "TeamId": team, "PersonId": person}
    return {"Frame": frame, "FrameSet": owner}


DOCUMENT = """<PutDataRequest><MatchInformation>
<General MatchId="{match}" HomeTeamId="{home}" GuestTeamId="G"/><Environment PitchX="105.0" PitchY="68.0"/>
<Teams><Team TeamId="{home}" TeamName="Home"><Players>{players}</Players><TrainerStaff><Trainer PersonId="t"/></TrainerStaff></Team>
<Team TeamId="G"><Players/><TrainerStaff/></Team></Teams>
<Referees><Referee PersonId="r1"/></Referees><OtherGameInformation TotalTimeFirstHalf="1"/>
</MatchInformation></PutDataRequest>"""


def _write(path, name, text):
    path.mkdir(exist_ok=True)
    (path / name).write_text(text)


def _player(person, position="TW", starting="false"):
    return f'<Player PersonId="{person}" PlayingPosition="{position}" Starting="{starting}"/>'


def test_time_major_json(spark, tmp_path):
    records = [
        {"n": 10000, "frames": [_entity(10000, "H", "h1"), _entity(10000, "BALL", None, x="oops", M="x")]},
        {"n": 10001, "frames": []},
        {"n": 10002, "frames": None},
        {"n": 10003, "frames": [_entity(10003, "H", "h1", x="NaN")]},
    ]
    # Numbers may come unquoted.
    records[0]["frames"][0]["Frame"]["Y"] = 2.25
    _write(tmp_path / "in", "a.json", "\n".join(json.dumps(r) for r in records))
    source = files.time_major_records(spark, str(tmp_path / "in"))
    rows = raw.raw_positions(source)
    assert rows.schema == schemas.RAW_POSITIONS
    got = {(r.frame_id, r.team_id): r for r in rows.collect()}
    assert set(got) == {(10000, "H"), (10000, "BALL"), (10003, "H")}
    assert got[10000, "H"].x == 1.5 and got[10000, "H"].y == 2.25 and got[10000, "H"].timestamp is not None
    assert got[10000, "BALL"].x is None and got[10000, "BALL"].m_flag is None and got[10003, "H"].x is None
    bad = {r.field: r.malformed for r in quality.malformed_numbers(raw.explode_frames(source)).collect()}
    assert bad["X"] == 2 and bad["M"] == 1 and bad["Y"] == 0


def test_whole_numbers_written_as_decimals(spark):
    texts = spark.createDataFrame([("1.0",), ("2",), ("x",), ("1.5",), ("",), (None,), ("9007199254740993",)], "text string")
    got = [tuple(r) for r in texts.select(raw.whole(texts.text), raw.whole(texts.text, "bigint")).collect()]
    assert got == [(1, 1), (2, 2), (None, None), (None, None), (None, None), (None, None), (None, 9007199254740993)]


def test_file_stream_equals_the_batch_read(spark, tmp_path):
    for n in range(3):
        _write(tmp_path / "in", f"{n}.json", json.dumps({"n": n, "frames": [_entity(n, "H", "h1")]}))
    stream = raw.raw_positions(files.time_major_records(spark, str(tmp_path / "in"), streaming=True, max_files=1))
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.frame_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2]


def test_match_documents(spark, tmp_path):
    keepers = _player("k1") + _player("p", "MIT", "true") + _player("k2", "tw", "true") + _player("k3", starting="1") + _player("k4")
    _write(tmp_path / "in", "b_02_01_matchinformation_.xml", DOCUMENT.format(match="M1", home="H", players=keepers))
    _write(tmp_path / "in", "a_02_01_matchinformation_.xml", DOCUMENT.format(match="", home="H", players=_player("x")))
    _write(tmp_path / "in", "c_02_01_matchinformation_.xml", DOCUMENT.format(match="M2", home="H", players=_player("late")))
    _write(tmp_path / "in", "d_02_01_matchinformation_.xml", DOCUMENT.format(match="M3", home="I", players=_player("i1") + _player("i2")))
    _write(tmp_path / "in", "other.xml", DOCUMENT.format(match="M9", home="Z", players=""))
    documents = files.match_documents(spark, str(tmp_path / "in"), name_filter="*_02_01_matchinformation_*.xml")
    info = match_info.match_info(documents)
    assert info.schema == schemas.MATCH_INFO
    assert {r.match_id: (r.pitch_x, r.home_team_id) for r in info.collect() if r.match_id} == {
        "M1": (105.0, "H"), "M2": (105.0, "H"), "M3": (105.0, "I"),
    }
    parsed = match_info.parsed_documents(documents)
    assert sorted(r.General.MatchId for r in parsed.collect()) == ["M1", "M2", "M3"]
    one = parsed.filter("General.MatchId = 'M1'").first()
    assert [p.PersonId for p in one.Teams[0].Players] == ["k1", "p", "k2", "k3", "k4"] and one.Teams[1].Players == []
    assert one.Referees[0].PersonId == "r1" and one.Teams[0].TrainerStaff[0].PersonId == "t"
    fallback = spark.createDataFrame([("H", "no"), ("Q", "q1")], "team_id string, goalkeeper_id string")
    got = {r.team_id: r.goalkeeper_id for r in match_info.goalkeepers(parsed, fallback).collect()}
    assert got == {"H": "k3", "I": "i1", "Q": "q1"}


def test_overrides_replace_known_matches(spark, tmp_path):
    known = constants.POSSESSION_SLOTS[0][0]
    _write(tmp_path / "in", f"{known}.json", json.dumps({"home_team_id": "X", "guest_team_id": "Y", "pitch_x": 100.0}))
    _write(tmp_path / "in", "n.json", json.dumps({"match_id": "NEW", "home_team_id": "A", "guest_team_id": "B"}))
    _write(tmp_path / "in", "bad.json", "{nonsense")
    overrides = files.match_overrides(spark, str(tmp_path / "in"))
    got = {r.match_id: tuple(r)[1:] for r in match_info.overlay(overrides, constants.known_matches(spark)).collect()}
    assert got[known] == (100.0, 68.0, "X", "Y") and got["NEW"] == (105.0, 68.0, "A", "B")
    assert len(got) == len(constants.POSSESSION_SLOTS) + 1


def test_messages_and_framing(spark):
    values = [(json.dumps(_entity(5, "H", "h1")), "t1"), ("{broken", "t1"), (json.dumps(_entity(6, "H", "h1")), "t2")]
    topic = spark.createDataFrame(values, "value string, topic string").selectExpr(
        "cast(value as binary) as value", "timestamp'2023-01-01 00:00:01' as timestamp", "topic"
    )
    rows = raw.message_positions(topic, "t1")
    assert len(rows.columns) == 15
    good = rows.filter("match_id is not null").collect()
    assert [(r.frame_id, r._arrival_ms, r.timestamp) for r in good] == [(5, 1672531201000, "2023-01-01T12:00:00.040Z")]
    framed = sinks.as_messages(rows.filter("frame_id = 5"), ["match_id", "x"]).first()
    assert framed.key == "7" and json.loads(framed.value) == {"match_id": "7", "x": 1.5}
    assert sinks.as_messages(rows, ["x"]).columns == ["value"]
    assert sinks.arrival_order(rows.drop("_arrival_ms")).filter("_arrival_ms is null").count() == rows.count()


def test_event_details_are_flattened(spark):
    play = {"EventDetails": {"Player": "top", "Pass": {"Direction": "d"}, "xG": "0.1"}, "EventId": "1", "X-Position": "3"}
    kick = {"EventDetails": {"Play": {"Player": "in", "Team": "H", "Pass": {"FreeKickLayup": "f"}}}, "EventId": "2"}
    topic = spark.createDataFrame([(json.dumps(e),) for e in (play, kick)], "value string").selectExpr(
        "value", "timestamp'2023-01-01' as timestamp", "'e' as topic"
    )
    flat = events.flattened_events(messages.event_messages(topic))
    assert len(flat.schema["EventDetails"].dataType.names) == 69
    one, two = sorted(flat.collect(), key=lambda r: r.EventId)
    assert (one.EventDetails.Player, one.EventDetails.PassDirection, one.EventDetails.xG) == ("top", "d", "0.1")
    assert (two.EventDetails.Player, two.EventDetails.Team, two.EventDetails.PassFreeKickLayup) == ("in", "H", "f")
    assert one["X-Position"] == "3"


def test_match_information_messages(spark):
    body = json.dumps({"General": {"MatchId": "M"}, "Teams": [{"TeamId": "H", "Players": [{"PersonId": "p"}]}]})
    topic = spark.createDataFrame([(body,)], "value string").selectExpr(
        "value", "timestamp'2023-01-01' as timestamp", "'m' as topic"
    )
    document = messages.match_information_messages(topic, "m").first().document
    assert document.General.MatchId == "M" and document.Teams[0].Players[0].PersonId == "p"


def test_batch_pipeline_end_to_end(spark, tmp_path):
    records = []
    for n in range(10000, 10006):
        entities = [_entity(n, "BALL", "b", x="0", S="9")]
        for team, side in (("H", -1), ("G", 1)):
            entities += [_entity(n, team, f"{team}{i}", x=str(side * (10 + 5 * i))) for i in range(3)]
        for e in entities:
            e["Frame"]["BallPossession"] = "1" if n < 10004 else "2"
        records.append({"n": n, "frames": entities})
    _write(tmp_path / "json", "a.json", "\n".join(json.dumps(r) for r in records))
    _write(tmp_path / "xml", "a.xml", DOCUMENT.format(match="7", home="H", players=""))
    tables = pipeline.run_batch(spark, str(tmp_path / "json"), str(tmp_path / "xml"), str(tmp_path / "out"))
    got = spark.read.parquet(tables.path("gold_possessions")).collect()
    assert {(r.team_id, r.possession_id, r.duration_sec, r.avg_ball_speed) for r in got} == {
        ("H", 10000, 0.16, 9.0), ("G", 10004, 0.08, 9.0),
    }
    assert len(list((tmp_path / "out" / "gold_possessions" / "match_id=7").glob("*.parquet"))) == 1
    silver = files.stage_table(spark, tables.path("silver_positions"), schemas.SILVER_POSITIONS)
    assert silver.schema["match_id"].dataType.simpleString() == "string" and silver.count() == 42
    pruned = silver.filter("match_id = '7'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(match_id" in pruned


def test_rejects_and_good_rows_add_up(spark, tmp_path):
    good = json.dumps({"n": 1, "frames": [_entity(1, "H", "h1")]})
    lines = [good, good[:-9], "nonsense", '{"n": 2, "frames": []}', '{"n": 3}', '{"n": 4, "frames": "x"}', '{"n": "y", "frames": [{}]}', "", good]
    _write(tmp_path / "in", "a.json", "\n".join(lines))
    split = quarantine.time_major(quarantine.text_lines(spark, str(tmp_path / "in")))
    assert [r.n for r in split.good.collect()] == [1, 1] and raw.raw_positions(split.good).count() == 2
    rejects = split.rejects.collect()
    assert split.rejects.columns == list(quarantine.REJECT_COLUMNS)
    assert sorted(r.reason for r in rejects) == ["no entities"] * 2 + ["not a record"] * 4 and {r.file for r in rejects} == {"a.json"}
    assert {r.text for r in rejects} == set(lines) - {good, ""}


def test_rejected_messages(spark):
    entity = _entity(5, "H", "h1")
    nobody = {"Frame": {"N": "1"}, "FrameSet": {}}
    texts = [json.dumps(entity), "{broken", json.dumps(nobody), None]
    topic = spark.createDataFrame([(t,) for t in texts], "value string").selectExpr("value", "timestamp'2023-01-01' as timestamp", "'t' as topic")
    split = quarantine.entity_messages(topic, "t")
    assert [r.frame_id for r in raw.message_positions(split.good).collect()] == [5]
    assert sorted((r.reason, r.text or "") for r in split.rejects.collect()) == [
        ("no match or frame", json.dumps(nobody)), ("not a message", ""), ("not a message", "{broken")
    ]


def test_rejected_documents_and_overrides(spark, tmp_path):
    whole = DOCUMENT.format(match="M1", home="H", players=_player("k", "TW", "true"))
    _write(tmp_path / "xml", "one.xml", whole)
    _write(tmp_path / "xml", "two.xml", whole.replace("M1", "M2") + whole.replace("M1", "M3"))
    _write(tmp_path / "xml", "cut.xml", whole[: len(whole) // 2])
    _write(tmp_path / "xml", "odd.xml", whole.replace("<Teams>", "<Teams"))
    _write(tmp_path / "xml", "none.xml", DOCUMENT.format(match="", home="H", players=""))
    split = quarantine.match_documents(quarantine.text_lines(spark, str(tmp_path / "xml"), whole=True))
    assert {r.match_id: tuple(r)[1:] for r in match_info.match_info(split.good).collect()} == dict.fromkeys(("M1", "M2", "M3"), (105.0, 68.0, "H", "G"))
    plain = files.match_documents(spark, str(tmp_path / "xml"), name_filter="one.xml").drop("source_file")
    assert split.good.filter("source_file = 'one.xml'").drop("source_file").collect() == plain.collect()
    assert match_info.goalkeepers(match_info.parsed_documents(split.good)).first().goalkeeper_id == "k"
    assert {r.file: r.reason for r in split.rejects.collect()} == {"cut.xml": "no document", "odd.xml": "not a document", "none.xml": "no match"}
    _write(tmp_path / "json", "A.json", json.dumps({"home_team_id": "X", "pitch_x": 100}, indent=1))
    _write(tmp_path / "json", "bad.json", "{nonsense")
    overrides = quarantine.match_overrides(quarantine.text_lines(spark, str(tmp_path / "json"), whole=True))
    assert [tuple(r) for r in overrides.good.collect()] == [("A", 100.0, None, "X", None)]
    assert [(r.file, r.text) for r in overrides.rejects.collect()] == [("bad.json", "{nonsense")]


def _records(match, frames, holder):
    for n in frames:
        entities = [_entity(n, "BALL", "b", x="0", S="9")]
        for team, side in (("H", -1), ("G", 1)):
            entities += [_entity(n, team, f"{team}{i}", x=str(side * (10 + 5 * i))) for i in range(3)]
        for e in entities:
            e["Frame"]["BallPossession"] = holder(n)
            e["FrameSet"]["MatchId"] = match
        yield json.dumps({"n": n, "frames": entities})


def test_growing_folders_equal_one_run(spark, tmp_path):
    holder = lambda n: "1" if n < 10004 else "2"
    both = {m: list(_records(m, range(10000, 10008), holder)) for m in ("7", "8")}
    growing = incremental.Growing(str(tmp_path / "json"), str(tmp_path / "xml"), str(tmp_path / "out"))
    _write(tmp_path / "json", "a.json", "\n".join([*both["7"], *both["8"][:3], "broken"]))
    _write(tmp_path / "xml", "a.xml", DOCUMENT.format(match="7", home="H", players=""))
    assert incremental.advance(spark, growing)
    kept = sorted((tmp_path / "out/gold_possessions/match_id=7").glob("*.parquet"))
    _write(tmp_path / "json", "b.json", "\n".join(both["8"][3:]))
    _write(tmp_path / "xml", "b.xml", DOCUMENT.format(match="8", home="H", players=""))
    # A call that breaks off after taking up files is made up for by the next.
    incremental.take_up(spark, growing)
    assert incremental.publish(spark, growing) and not incremental.advance(spark, growing)
    assert sorted((tmp_path / "out/gold_possessions/match_id=7").glob("*.parquet")) == kept
    _write(tmp_path / "whole", "a.json", "\n".join([*both["7"], *both["8"]]))
    tables = pipeline.run_batch(spark, str(tmp_path / "whole"), growing.documents, str(tmp_path / "once"))
    for stage in ("bronze_positions", "silver_positions", "gold_possessions"):
        one, other = (spark.read.parquet(p) for p in (tables.path(stage), growing.path(stage)))
        assert sorted(map(str, one.collect())) == sorted(map(str, other.select(*one.columns).collect()))
    assert [tuple(r) for r in incremental.rejects(spark, growing).collect()] == [("time_major", "a.json", "broken", "not a record")]
