"""Possession sequences of an endless stream, in keyed state with timers.

All rows of a half meet under its key. Its state holds the rows of frames that may still be incomplete, the direction of each team, the last finished
frame and the sequence that may still go on. A frame is finished once a frame ``lateness`` numbers later has come: frame numbers are the
half's own event time, so a delayed match does not hold others back, nor is it cut off by them. Rows of finished frames are counted as late.

The rows of a batch may be many for one half. Its worker takes them up piece by piece, sorts them by frame with files of its own (``sorted_rows``) and takes
the finished frames into the sequences slice by slice, so its memory grows with neither the rows of a batch nor the length of a half.

A half of which nothing has come for ``idle`` closes by a processing-time timer: its last frames are finished and its last sequence is emitted, also when
no later half ever starts. Silence begins with the first batch that brings the half nothing, so the time that the batch before it took is none. What is then left of it, directions and last frame, Spark evicts after ``keep``. So state grows with the halves that are being
played, not with their frames.

Reading messages, match metadata, coordinates for both directions and rounding are DataFrame expressions before the state, the contract's columns
after it; only the steps between frames run in the state's Python worker. The state needs Spark's RocksDB provider, which ``start`` selects.
The file sink makes output exactly-once over restarts.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from touchline import schemas
from touchline.functions.geometry import normalise_x
from touchline.plans import bronze, gold, raw
from touchline.sources import constants
from touchline.streaming.sorted_rows import SortedRows

SECTION = bronze.SECTION
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Numbers by which frames may be late, milliseconds of silence after which a half ends, and for which its last state is kept.
LATENESS, IDLE, KEEP = 25, 60_000, 6 * 3_600_000

ROW = {
    "frame_id": "long", "team_id": "string", "person_id": "string", "known": "boolean", "ball_possession": "string",
    # Whole numbers that may be missing are doubles in pandas, and so they are here.
    **dict.fromkeys(("x", "ahead", "back", "speed", "ball_status", "speed_sum", "ahead_sum", "back_sum"), "double"),
}
LATE_ROW = {name: ROW[name] for name in ("frame_id", "team_id")}
_SUMS = [f"{name}_{part}" for name in gold.AVERAGED for part in ("sum", "n")]
RUN = {"team_id": "string", "run_start": "long", "run_end": "long", "opponent_id": "string", "num_frames": "long", **dict.fromkeys(_SUMS, "long")}
SEQUENCE, LATE = "sequence", "late"


def _ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields.items())


def _scaled(value: Column, digits: int) -> Column:
    return F.round(value * F.lit(float(10**digits))).cast("bigint")


def state_rows(messages: DataFrame, info: DataFrame, topic: str | None = None) -> DataFrame:
    """Rows for the state: both possible coordinates, and every averaged value as a whole number of its last unit."""
    rows = raw.message_positions(messages, topic).filter(F.col("match_id").isNotNull() & F.col("frame_id").isNotNull())
    placed = bronze.with_possessing_team(bronze.with_match_info(rows, info), "ball_possession_code")
    team = F.col("team_id")
    known = team.isNotNull() & (team != schemas.REFEREE) & (F.col("person_id").isNotNull() | (team == schemas.BALL))
    sides = placed.withColumns(
        {name: normalise_x(F.col("x"), F.lit(direction), F.col("pitch_x")) for name, direction in (("ahead", 1), ("back", -1))}
    )
    sums = {"speed_sum": _scaled(F.col("speed"), gold.SPEED_DIGITS)}
    sums |= {f"{name}_sum": _scaled(F.col(name), gold.LINE_DIGITS) for name in ("ahead", "back")}
    return sides.withColumns({"known": F.coalesce(known, F.lit(False)), **sums}).select(
        *SECTION, *[F.col(name).cast(kind) for name, kind in ROW.items()]
    )


def _first_of(rows: pd.DataFrame, by: list[str], column: str, last: bool = False) -> pd.Series:
    """Per frame the first (or last) present value in the order of ``by``."""
    ordered = rows[rows[column].notna()].sort_values(by, na_position="first").groupby("frame_id")[column]
    return ordered.last() if last else ordered.first()


def frame_facts(rows: pd.DataFrame, directions: dict[str, int], k: int) -> pd.DataFrame:
    """Active frames in order: possessing team, opponent, and the values of the sequence averages."""
    rows = rows[rows["known"]].reset_index(drop=True)
    is_ball = rows["team_id"] == schemas.BALL
    order = ["person_id", "x", "ball_possession", "ball_status"]
    balls = rows[is_ball].assign(person_id=rows["person_id"].fillna("")).sort_values(order, na_position="first")
    ball = balls.drop_duplicates("frame_id").set_index("frame_id")
    for name in ("ball_possession", "ball_status"):
        held = rows["frame_id"].map(ball[name])
        rows = rows.assign(**{name: held.where(held.notna(), rows[name])})
    rows = rows[rows["ball_status"] == 1]
    is_ball = rows["team_id"] == schemas.BALL
    held = rows["ball_possession"].notna()
    own = held & (rows["ball_possession"] == rows["team_id"])
    turned = rows["team_id"].map(directions) == 1
    players = rows.assign(own=own, at=rows["ahead"].where(turned, rows["back"]), line=rows["ahead_sum"].where(turned, rows["back_sum"]))
    players = players[~is_ball & held & players["at"].notna()].sort_values(["frame_id", "own", "at"])
    kth = players[players.groupby(["frame_id", "own"]).cumcount() == k].set_index("frame_id")
    facts = pd.DataFrame(index=np.sort(rows["frame_id"].unique()))
    facts["team_id"] = _first_of(rows, ["frame_id", "ball_possession"], "ball_possession", last=True)
    facts["opponent_id"] = _first_of(rows[~is_ball & held & ~own], ["frame_id", "team_id"], "team_id", last=True)
    facts["avg_ball_speed"] = _first_of(rows[is_ball], ["frame_id", "speed"], "speed_sum", last=True)
    facts["avg_offside_line"] = kth.loc[kth["own"], "line"]
    facts["opponent_avg_offside_line"] = kth.loc[~kth["own"], "line"]
    return facts


def runs_of(facts: pd.DataFrame) -> list[dict]:
    """Runs of consecutive frames with one possessing team, in order."""
    frame, team = facts.index.to_numpy(), facts["team_id"].astype(object).where(facts["team_id"].notna(), None).to_numpy()
    opens = np.ones(len(frame), dtype=bool)
    opens[1:] = (np.diff(frame) != 1) | (team[1:] != team[:-1])
    starts = np.flatnonzero(opens)
    if not len(starts):
        return []
    ends = np.append(starts[1:], len(frame))
    codes, names = pd.factorize(facts["opponent_id"], sort=True)
    most = np.maximum.reduceat(codes, starts).tolist()
    columns = {
        "team_id": team[starts].tolist(), "run_start": frame[starts].tolist(), "run_end": frame[ends - 1].tolist(),
        "opponent_id": [names[code] if code >= 0 else None for code in most], "num_frames": (ends - starts).tolist(),
    }
    for name in gold.AVERAGED:
        value = facts[name].to_numpy(dtype=np.float64)
        counts = np.add.reduceat((~np.isnan(value)).astype(np.int64), starts).tolist()
        sums = np.add.reduceat(np.nan_to_num(value), starts).tolist()
        columns |= {f"{name}_sum": [int(total) if count else None for total, count in zip(sums, counts)], f"{name}_n": counts}
    return [dict(zip(columns, values)) for values in zip(*columns.values())]


def joined_runs(one: dict, other: dict) -> dict:
    """Two runs of one team, the second of which goes on where the first ends."""
    made = {**other, "run_start": one["run_start"]}
    for name in ("num_frames", *_SUMS):
        values = [v for v in (one[name], other[name]) if v is not None]
        made[name] = sum(values) if values else None
    made["opponent_id"] = max((v for v in (one["opponent_id"], other["opponent_id"]) if v is not None), default=None)
    return made


class Sequences(StatefulProcessor):
    """State of one half."""

    def __init__(self, lateness: int, idle: int, keep: int, k: int):
        self.lateness, self.idle, self.keep, self.k = lateness, idle, keep, k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", _ddl(ROW))
        self.directions = handle.getMapState("directions", "team_id string", "direction int", self.keep)
        self.going_on = handle.getValueState("open", _ddl(RUN))
        self.last = handle.getValueState("last", "frame_id long", self.keep)
        self.silent = handle.getValueState("silent", "since long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else None
        with SortedRows(ROW) as held, SortedRows(LATE_ROW) as late:
            for arrived in rows:
                if last is not None:
                    finished = arrived["frame_id"] <= last
                    late.add(arrived.loc[finished, [*LATE_ROW]])
                    arrived = arrived[~finished]
                held.add(arrived[[*ROW]])
            for part in late.slices():
                counted = part.groupby(["frame_id", "team_id"], dropna=False).size().reset_index(name="num_frames")
                yield self._output(key, LATE, counted.rename(columns={"frame_id": "run_start"}))
            if self.pending.exists():
                held.add(pd.DataFrame([tuple(row) for row in self.pending.get()], columns=[*ROW]))
            rest = []
            for part in held.slices():
                done = part["frame_id"] <= held.newest - self.lateness
                if done.any():
                    yield from self._advance(key, part[done], finish=False)
                if not done.all():
                    rest.append(part[~done].astype(object))
            if held.newest is not None:
                self.pending.put([row for part in rest for row in part.where(part.notna(), None).itertuples(index=False, name=None)])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        # The next batch sees whether the half is silent; this one may take longer than ``idle``.
        self.silent.clear()
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.silent.exists():
            now = timerValues.getCurrentProcessingTimeInMs()
            self.silent.update((now,))
            self.handle.registerTimer(now + self.idle)
            return
        self.silent.clear()
        held = pd.DataFrame([tuple(row) for row in self.pending.get()] if self.pending.exists() else [], columns=[*ROW])
        yield from self._advance(key, held, finish=True)
        self.pending.clear()

    def close(self) -> None:
        pass

    def _advance(self, key, rows: pd.DataFrame, finish: bool) -> Iterator[pd.DataFrame]:
        """Takes finished frames into the sequences; ``finish`` closes the last one."""
        runs = [dict(zip(RUN, self.going_on.get(), strict=True))] if self.going_on.exists() else []
        last = None
        if len(rows):
            last = int(rows["frame_id"].max())
            for run in runs_of(frame_facts(rows, self._known_directions(rows), self.k)):
                follows = runs and runs[-1]["team_id"] == run["team_id"] and runs[-1]["run_end"] + 1 == run["run_start"]
                runs[-1:] = [joined_runs(runs[-1], run)] if follows else [*runs[-1:], run]
            self.last.update((last,))
        stays = bool(runs) and not finish and (last is None or runs[-1]["run_end"] == last)
        if stays:
            self.going_on.update(tuple(runs.pop().values()))
        else:
            self.going_on.clear()
        if runs:
            yield self._output(key, SEQUENCE, pd.DataFrame(runs))

    def _known_directions(self, rows: pd.DataFrame) -> dict[str, int]:
        """Of the first frame that has a player with a position: +1 where the leftmost is farther from the centre than the rightmost."""
        if self.directions.exists():
            return {team[0]: direction[0] for team, direction in self.directions.iterator()}
        players = rows[rows["team_id"].notna() & ~rows["team_id"].isin([schemas.BALL, schemas.REFEREE]) & rows["x"].notna()]
        first = players[players["frame_id"] == players["frame_id"].min()].groupby("team_id")["x"].agg(["min", "max"])
        found = {team: 1 if abs(low) > abs(high) else -1 for team, low, high in first.itertuples()}
        for team, direction in found.items():
            self.directions.updateValue((team,), (direction,))
        return found

    def _output(self, key, kind: str, rows: pd.DataFrame) -> pd.DataFrame:
        made = rows.reindex(columns=[*RUN]).assign(kind=kind, match_id=key[0], game_section=key[1]).astype(object)
        return made.where(made.notna(), None)[["kind", *SECTION, *RUN]]


def possession_stream(
    messages: DataFrame, info: DataFrame, topic: str | None = None, lateness: int = LATENESS, idle: int = IDLE, keep: int = KEEP,
    k: int = constants.OFFSIDE_LINE_INDEX,
) -> DataFrame:
    """Closed sequences (``kind`` is ``sequence``) as mergeable sums, and counts of late rows by frame (``run_start``) and team (``late``)."""
    output = _ddl({"kind": "string", "match_id": "string", "game_section": "string", **RUN})
    return state_rows(messages, info, topic).groupBy(*SECTION).transformWithStateInPandas(
        Sequences(lateness, idle, keep, k), output, "Append", "ProcessingTime"
    )


def sequences(emitted: DataFrame, rounded: bool = True) -> DataFrame:
    """The gold contract of what the stream has written."""
    return gold.sequence_columns(emitted.filter(F.col("kind") == SEQUENCE), rounded)


def late_rows(emitted: DataFrame) -> DataFrame:
    """``match_id, game_section, frame_id, team_id, late_rows``: what came after its frame was finished."""
    late = emitted.filter(F.col("kind") == LATE)
    return late.groupBy(*SECTION, F.col("run_start").alias("frame_id"), "team_id").agg(F.sum("num_frames").alias("late_rows"))


def start(
    emitted: DataFrame, path: str, checkpoint: str, interval: str = constants.TRIGGER_INTERVAL, by: tuple[str, ...] = ("kind",)
) -> StreamingQuery:
    """Writes a stream of keyed state to a parquet folder. Timers need batches, so the stream runs until it is stopped."""
    emitted.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    writer = emitted.writeStream.format("parquet").partitionBy(*by).option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=interval).start()


def await_silence(query: StreamingQuery, idle: int = IDLE, timeout: float = 600.0) -> None:
    """Waits until rows have come and, unless ``idle`` is negative, until all their halves have closed.

    They close in a batch that begins ``idle`` milliseconds after the first batch without rows; that one's timers count from some time before its end.
    A batch that takes up rows may take longer than ``timeout``, which counts again from its end.
    """
    until, fed, silent = time.monotonic() + timeout, None, None
    while query.isActive:
        # The status is read first: once it says that a batch is over, its progress is there.
        over = time.monotonic() >= until and not (silent is None and query.status["isDataAvailable"])
        for progress in query.recentProgress:
            begun = datetime.fromisoformat(progress["timestamp"])
            if progress["numInputRows"]:
                if fed is None or begun > fed:
                    fed, silent, until = begun, None, time.monotonic() + timeout
            elif fed is not None and begun > fed:
                if silent is None:
                    silent = begun + timedelta(milliseconds=progress["durationMs"].get("triggerExecution", 0))
                elif idle >= 0 and begun > silent + timedelta(milliseconds=idle):
                    return
        if fed is not None and idle < 0:
            return
        if over and time.monotonic() >= until:
            break
        time.sleep(0.1)
    if query.exception() is not None:
        raise query.exception()
    raise TimeoutError("the stream did not become silent")
