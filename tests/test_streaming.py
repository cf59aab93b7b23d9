import json
import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from football import frame

from touchline.operators import runs
from touchline.plans import bronze, gold, raw, silver
from touchline.sources import messages
from touchline.streaming import lags, levels, possessions

HOLDERS = [1, 1, 2, 2, 2, 0, 1, 1, 1, 1, 2, 1]
INFO = "match_id string, pitch_x double, pitch_y double, home_team_id string, guest_team_id string"


def _entities():
    """Twelve frames of one half with the ball's id set, as raw values per frame."""
    result = []
    for n, code in enumerate(HOLDERS):
        rows = [r for r in frame(n, number=10000 + n)]
        result.append(
            [
                {
                    "Frame": {"N": str(r[2]), "X": str(r[5]), "Y": str(r[6]), "D": str(r[9]), "S": str(r[10]), "A": str(r[11]),
                              "T": "2023-01-01T00:00:00Z", "M": "1", "BallPossession": str(code), "BallStatus": "1"},
                    "FrameSet": {"MatchId": r[0], "GameSection": r[1], "TeamId": r[3],
                                 "PersonId": "b" if r[3] == "BALL" else r[4]},
                }
                for r in rows
            ]
        )
    return result


def _info(spark):
    return spark.createDataFrame([("M", 105.0, 68.0, "H", "G")], INFO)


def _run(spark, tmp_path, cuts, begin):
    """Feeds the entities cut at the given row numbers, one query run per piece."""
    lines = [json.dumps(e) for f in _entities() for e in f]
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    bounds = [0, *cuts, len(lines)]
    for n, (start, end) in enumerate(zip(bounds, bounds[1:])):
        (inbox / f"{n}.txt").write_text("\n".join(lines[start:end]))
        source = messages.file_messages(spark, str(inbox), "t", max_files=None)
        begin(source, str(tmp_path / "cp")).awaitTermination()
        time.sleep(0.05)
    return len(bounds) - 2


IDLE = 1_000


def _batch_gold(spark):
    """The batch's sequences over the same messages."""
    lines = [(json.dumps(e),) for f in _entities() for e in f]
    topic = spark.createDataFrame(lines, "value string").selectExpr(
        "value", "timestamp'2023-01-01' as timestamp", "'t' as topic"
    )
    rows = raw.message_positions(topic).withColumnRenamed("ball_possession_code", "ball_possession")
    rows = rows.selectExpr("*", "cast(null as double) as z")
    known = silver.silver_positions(bronze.bronze_positions(rows, _info(spark)))
    return sorted(map(str, gold.gold_possessions(known, rounded=False).collect()))


class _Inbox:
    """A possession stream over a folder of messages, started anew for every piece."""

    def __init__(self, spark, folder, **settings):
        self.spark, self.folder, self.settings, self.pieces = spark, folder, settings, 0
        (folder / "inbox").mkdir()

    def start(self):
        source = messages.file_messages(self.spark, str(self.folder / "inbox"), "t", max_files=None)
        emitted = possessions.possession_stream(source, _info(self.spark), "t", **{"idle": IDLE, **self.settings})
        return possessions.start(emitted, str(self.folder / "out"), str(self.folder / "cp"), interval="100 milliseconds")

    def add(self, entities):
        (self.folder / f"{self.pieces}.tmp").write_text("\n".join(json.dumps(e) for e in entities))
        (self.folder / f"{self.pieces}.tmp").rename(self.folder / "inbox" / f"{self.pieces}.txt")
        self.pieces += 1

    def feed(self, entities, silent):
        """One run of the stream: takes the piece, and if ``silent`` waits until its halves have closed."""
        self.add(entities)
        query = self.start()
        try:
            possessions.await_silence(query, self.settings.get("idle", IDLE) if silent else -1)
        finally:
            query.stop()

    def emitted(self):
        return self.spark.read.parquet(str(self.folder / "out"))


def test_possessions_do_not_depend_on_the_batches(spark, tmp_path):
    entities = [e for f in _entities() for e in f]
    # Cut inside frames: the ball of a frame may come a run after its players. The last half closes by silence alone.
    for name, cuts in (("one", []), ("three", [24 * 3 + 10, 24 * 8 + 5])):
        (tmp_path / name).mkdir()
        inbox = _Inbox(spark, tmp_path / name, lateness=2, idle=10_000 if cuts else IDLE)
        bounds = [0, *cuts, len(entities)]
        for start, end in zip(bounds, bounds[1:]):
            inbox.feed(entities[start:end], silent=end == len(entities))
        got = possessions.sequences(inbox.emitted(), rounded=False)
        assert sorted(map(str, got.collect())) == _batch_gold(spark)
        assert possessions.late_rows(inbox.emitted()).count() == 0


def test_frames_may_come_in_any_order_within_the_lateness(spark, tmp_path):
    frames = _entities()
    inbox = _Inbox(spark, tmp_path, lateness=4, idle=10_000)
    order = [2, 0, 1, 4, 3, 6, 5, 7, 10, 8, 9, 11]
    entities = [e for n in order for e in frames[n]]
    inbox.feed(entities[: 24 * 6], silent=False)
    inbox.feed(entities[24 * 6 :], silent=True)
    assert sorted(map(str, possessions.sequences(inbox.emitted(), rounded=False).collect())) == _batch_gold(spark)


def test_late_rows_are_counted_apart(spark, tmp_path):
    frames = _entities()
    inbox = _Inbox(spark, tmp_path, lateness=1, idle=8_000)
    inbox.feed([e for n in (0, 1, 2, 3) for e in frames[n]], silent=False)
    inbox.feed([e for n in (1, 4) for e in frames[n]], silent=True)
    late = possessions.late_rows(inbox.emitted()).collect()
    assert {(r.frame_id, r.team_id): r.late_rows for r in late} == {(10001, "H"): 11, (10001, "G"): 11, (10001, "BALL"): 1, (10001, "referee"): 1}
    assert {r.possession_id for r in possessions.sequences(inbox.emitted()).collect()} == {10000, 10002, 10004}


class _Kept:
    """A state variable in memory."""

    def __init__(self):
        self.held = None

    def exists(self):
        return bool(self.held)

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    put = update

    def clear(self):
        self.held = None

    def updateValue(self, key, value):
        self.held = {**(self.held or {}), key: value}

    def iterator(self):
        return iter(self.held.items())


class _Clock:
    """Handle and clock of one key: ``at`` is the time of the batch."""

    def __init__(self):
        self.timers, self.at = set(), 0

    def getListState(self, *_):
        return _Kept()

    getMapState = getValueState = getListState

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, timer):
        self.timers.discard(timer)

    def registerTimer(self, timer):
        self.timers.add(timer)

    def getCurrentProcessingTimeInMs(self):
        return self.at

    def expire(self, processor, at):
        """Sequences of a batch at a time that brings the key nothing."""
        self.at, due = at, {timer for timer in self.timers if timer <= at}
        self.timers -= due
        return [row for _ in due for part in processor.handleExpiredTimer(("M", "firstHalf"), self, None) for row in part["run_start"]]


def _state_rows(frames):
    names = {"ahead": 60.0, "back": 45.0, "speed": 1.0, "ball_status": 1.0, "speed_sum": 1000.0, "ahead_sum": 6000.0, "back_sum": 4500.0}
    rows = [{"frame_id": n, "team_id": team, "person_id": "p", "known": True, "ball_possession": "H", "x": 1.0, **names} for n in frames for team in ("H", "BALL")]
    return pd.DataFrame(rows)[[*possessions.ROW]]


def test_a_slow_batch_is_no_silence():
    clock, processor = _Clock(), possessions.Sequences(lateness=1, idle=1_000, keep=1, k=0)
    processor.init(clock)
    assert not [*processor.handleInputRows(("M", "firstHalf"), iter([_state_rows((1, 2))]), clock)]
    # The batch took five seconds, so the next one begins long after ``idle``: only now is there silence to count.
    assert clock.expire(processor, 5_000) == [] and clock.expire(processor, 5_999) == []
    clock.at = 5_999
    assert not [*processor.handleInputRows(("M", "firstHalf"), iter([_state_rows((3, 4))]), clock)]
    assert clock.expire(processor, 9_000) == [] and clock.expire(processor, 9_999) == []
    assert clock.expire(processor, 10_000) == [1] and not clock.timers


def test_silence_is_awaited_to_its_end():
    start = datetime(2024, 1, 1)

    def batch(begun, rows, took=100):
        return {"timestamp": (start + timedelta(milliseconds=begun)).isoformat(), "numInputRows": rows, "durationMs": {"triggerExecution": took}}

    class Query:
        isActive, recentProgress = True, [batch(0, 5, 3_000), batch(3_000, 0), batch(3_200, 0)]

        def exception(self):
            return None

    with pytest.raises(TimeoutError):
        possessions.await_silence(Query(), 1_000, timeout=0.3)
    Query.recentProgress = [*Query.recentProgress, batch(4_101, 0)]
    possessions.await_silence(Query(), 1_000, timeout=0.3)


def test_state_stays_flat(spark, tmp_path):
    inbox = _Inbox(spark, tmp_path, lateness=3, idle=60_000)
    entity = _entities()
    query = inbox.start()
    sizes = []
    try:
        for n in range(30):
            frame = json.loads(json.dumps(entity[n % 12]))
            for e in frame:
                e["Frame"]["N"] = str(10000 + n)
            inbox.add(frame)
            while sum(p["numInputRows"] > 0 for p in query.recentProgress) <= n:
                assert query.isActive
                time.sleep(0.02)
            sizes.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["numInputRows"]][-1])
    finally:
        query.stop()
    assert max(sizes[6:]) == max(sizes[6:12])


def test_levels_switches_and_counts(spark, tmp_path):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    pipeline = levels.LevelPipeline(
        _info(spark), levels.to_tables(str(tmp_path / "out")), topic="t", build=("bronze", "grouped"), emit=("grouped",),
        audit=True,
    )
    _run(spark, tmp_path, [], lambda s, cp: levels.start(s, pipeline, cp, interval=None))
    assert pipeline.counts == {"bronze": 288, "grouped": 36}
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"grouped", "audit", "unknown_matches", "ledger"}
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_bronze_alone_builds_no_silver(spark, monkeypatch):
    """Silver counts the rows of all frames before it is built."""
    built = []
    monkeypatch.setattr(silver, "silver_positions", lambda *a, **b: built.append(a))
    rows = [json.dumps(e) for frames in _entities() for e in frames]
    topic = spark.createDataFrame([(r, datetime(2023, 1, 1), "t") for r in rows], "value string, timestamp timestamp, topic string")
    pipeline = levels.LevelPipeline(_info(spark), topic="t", build=("bronze",))
    pipeline.process(topic, 0)
    assert pipeline.counts == {"bronze": len(rows)} and not built


def test_unknown_matches_in_strict_mode(spark):
    lines = [(json.dumps(e),) for e in _entities()[0]]
    topic = spark.createDataFrame(lines, "value string").selectExpr(
        "value", "timestamp'2023-01-01' as timestamp", "'t' as topic"
    )
    pipeline = levels.LevelPipeline(_info(spark).filter("match_id = 'other'"), topic="t", strict=True)
    with pytest.raises(PySparkException, match="no metadata for match M"):
        pipeline.process(topic, 0)


def test_a_batch_that_breaks_off_between_levels_is_made_up_for(spark, tmp_path):
    lines = [json.dumps(e) for f in _entities() for e in f]
    (tmp_path / "inbox").mkdir()
    (tmp_path / "inbox/0.txt").write_text("\n".join(lines))
    tables = levels.to_tables(str(tmp_path / "out"))

    class Breaking(levels.Tables):
        def __call__(self, level, rows, batch_id):
            if level == "grouped":
                raise ConnectionError("lost between two levels")
            super().__call__(level, rows, batch_id)

    def run(publish):
        source = messages.file_messages(spark, str(tmp_path / "inbox"), "t", max_files=None)
        levels.start(source, levels.LevelPipeline(_info(spark), publish, topic="t"), str(tmp_path / "cp"), interval=None).awaitTermination()

    with pytest.raises(PySparkException, match="lost between two levels"):
        run(Breaking(str(tmp_path / "out")))
    assert (tmp_path / "out/silver/batch=0").exists() and not (tmp_path / "out/ledger").exists()
    run(tables)
    assert {r.level: r.rows for r in tables.ledger(spark).collect()} == {"bronze": 288, "silver": 288, "grouped": 36, "gold": tables.read(spark, "gold").count()}
    assert tables.read(spark, "silver").count() == 288 and tables.read(spark, "grouped").count() == 36


def test_lags_across_batches_equal_the_batch(spark, tmp_path):
    numbers = [1, 2, 3, 1003, 1004, 2005, 2006]
    rows = [("M", n, p, float(n) if (n + len(p)) % 3 else None) for n in numbers for p in ("a", "bb")] + [("M", 5, None, 1.0), ("M", None, "a", 1.0)]
    schema = "match_id string, frame_id bigint, person_id string, ball_distance double"
    for low, high in ((0, 3), (3, 9), (9, 16)):
        spark.createDataFrame(rows[low:high], schema).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        query = possessions.start(lags.lagged_stream(source), str(tmp_path / "out"), str(tmp_path / "cp"), "100 milliseconds", by=())
        try:
            possessions.await_silence(query, -1)
        finally:
            query.stop()
    whole = spark.createDataFrame(rows[:14], schema)
    want = runs.previous_values(whole, lags.PLAYER, "frame_id", {"prev_ball_distance": "ball_distance"}, 1000)
    got = spark.read.parquet(str(tmp_path / "out")).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_event_mirror(spark, tmp_path):
    from touchline.streaming import mirror

    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for n in range(2):
        (inbox / f"{n}.txt").write_text(json.dumps({"EventId": str(n), "EventDetails": {"Play": {"Player": "p"}}}))
    source = messages.file_messages(spark, str(inbox), "e")
    mirror.mirror_events(source, str(tmp_path / "out"), str(tmp_path / "cp"), "e", interval=None).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.EventId, r.EventDetails.Player) for r in got) == [("0", "p"), ("1", "p")]
