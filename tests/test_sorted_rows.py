import time
import weakref
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from test_streaming import _Clock

from touchline.streaming import possessions, sorted_rows

KEY = ("M", "firstHalf")


def _rows(seed, frames, players=9):
    """Rows of whole frames in any order, with values missing; every four frames another team has the ball."""
    draw = np.random.default_rng(seed)
    count = len(frames) * (players + 1)
    rows = pd.DataFrame({"frame_id": np.repeat(frames, players + 1), "person_id": np.tile([f"p{n}" for n in range(players + 1)], len(frames))})
    rows["team_id"] = np.where(rows["person_id"] == "p0", "BALL", draw.choice(["H", "G"], count))
    rows["known"], rows["ball_status"] = True, np.where(draw.random(count) < 0.1, 0.0, 1.0)
    rows["ball_possession"] = np.array(["H", "G", None], dtype=object)[rows["frame_id"] // 4 % 3]
    rows["x"] = np.where(draw.random(count) < 0.1, np.nan, draw.integers(-5250, 5250, count) / 100)
    rows["ahead"], rows["back"], rows["speed"] = rows["x"] + 52.5, 52.5 - rows["x"], draw.integers(0, 9, count).astype(float)
    rows["speed_sum"], rows["ahead_sum"], rows["back_sum"] = rows["speed"] * 1000, (rows["ahead"] * 100).round(), (rows["back"] * 100).round()
    return rows.iloc[draw.permutation(count)].reset_index(drop=True)[[*possessions.ROW]]


def _pieces(rows, size):
    return [rows.iloc[n : n + size].reset_index(drop=True) for n in range(0, len(rows), size)]


def _emitted(batches, size):
    """What a half's state gives for batches of pieces, and for the silence after them."""
    clock, processor = _Clock(), possessions.Sequences(lateness=3, idle=10, keep=1, k=1)
    processor.init(clock)
    parts = [part for rows in batches for part in processor.handleInputRows(KEY, iter(_pieces(rows, size)), clock)]
    for clock.at in (100, 200):
        due = {timer for timer in clock.timers if timer <= clock.at}
        clock.timers -= due
        parts += [part for _ in due for part in processor.handleExpiredTimer(KEY, clock, None)]
    rows = pd.concat(parts).astype(object)
    return sorted(map(repr, rows.where(rows.notna(), None).map(lambda v: int(v) if isinstance(v, float) else v).itertuples(index=False, name=None)))


def test_a_large_batch_is_taken_up_piece_by_piece(monkeypatch):
    """Neither the pieces nor the finished frames of a half are ever all in the worker's frames of pandas."""
    taken, alive, most = [], weakref.WeakSet(), []
    facts = possessions.frame_facts
    monkeypatch.setattr(possessions, "frame_facts", lambda rows, *rest: taken.append(len(rows)) or facts(rows, *rest))

    class Piece:
        """Lives as long as its rows."""

    def arriving(rows):
        for n in range(0, len(rows), 10_000):
            part = rows.iloc[n : n + 10_000].copy()
            part.attrs["piece"] = piece = Piece()
            alive.add(piece)
            del piece
            most.append(len(alive))
            yield part
            del part

    rows = _rows(1, np.arange(30_000))
    clock, processor = _Clock(), possessions.Sequences(lateness=3, idle=10, keep=1, k=1)
    processor.init(clock)
    made = pd.concat(processor.handleInputRows(KEY, arriving(rows), clock))
    assert sum(taken) == 299_970 and max(taken) < 50_000 and max(most) <= 4
    assert made["num_frames"].astype(int).sum() > 26_000 and made["run_start"].is_monotonic_increasing


def test_slices_of_a_batch_give_the_sequences_of_the_whole(monkeypatch):
    late = 0
    for seed in range(4):
        draw = np.random.default_rng(seed)
        batches = [_rows(seed, np.arange(first, first + int(draw.integers(2, 40)))) for first in (0, 15, 30)]
        if seed % 4 == 0:
            batches = [rows.assign(ball_possession=None) for rows in batches]
        whole = _emitted(batches, 10_000)
        held, size, fan = int(draw.integers(1, 60)), int(draw.integers(1, 50)), int(draw.integers(2, 5))
        with monkeypatch.context() as small:
            small.setattr(sorted_rows, "PART", int(draw.integers(1, 9)))
            small.setattr(possessions, "SortedRows", lambda fields: sorted_rows.SortedRows(fields, held, size, fan))
            assert _emitted(batches, int(draw.integers(1, 60))) == whole
        late += sum("late" in row for row in whole)
    assert late


def test_slices_have_whole_frames_and_files_go(monkeypatch, tmp_path):
    monkeypatch.setenv("SPARK_LOCAL_DIRS", str(tmp_path))
    monkeypatch.setattr(sorted_rows, "PART", 4)
    rows = pd.concat([_rows(2, np.arange(200)), _rows(3, np.full(30, 77))], ignore_index=True)
    with sorted_rows.SortedRows(possessions.ROW, held=50, size=40, fan=3) as held:
        for piece in _pieces(rows.sample(frac=1, random_state=1), 7):
            held.add(piece)
        files = len([*next(tmp_path.iterdir()).iterdir()])
        slices = [*held.slices()]
    assert held.newest == 199 and 0 < files < 12
    assert not [*tmp_path.iterdir()]
    ends = [(part["frame_id"].min(), part["frame_id"].max()) for part in slices]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    assert all(len(part) <= 40 or part["frame_id"].nunique() == 1 for part in slices)
    order = ["frame_id", "person_id", "x", "speed", "team_id", "ball_status"]
    got, want = (part.sort_values(order, ignore_index=True) for part in (pd.concat(slices), rows))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_a_batch_in_work_is_awaited():
    begun = time.monotonic()

    class Query:
        """Its first batch takes a second."""

        isActive = True

        @property
        def status(self):
            return {"isDataAvailable": time.monotonic() < begun + 1.0}

        @property
        def recentProgress(self):
            done = {"timestamp": datetime(2024, 1, 1).isoformat(), "numInputRows": 5, "durationMs": {"triggerExecution": 1_000}}
            return [done] if time.monotonic() >= begun + 1.0 else []

        def exception(self):
            return None

    possessions.await_silence(Query(), -1, timeout=0.3)
    with pytest.raises(TimeoutError):
        possessions.await_silence(Query(), 1_000, timeout=0.3)
