"""Previous values per player across micro-batches, in keyed state.

Each player of a half keeps its newest frame and the values in it; a row takes those of the frame before it, whichever batch that came in. Beyond a
jump of more than ``max_gap`` frames there is no previous value, as in the batch (``operators.shape.with_lags``). Rows that are not later than the
newest frame of an earlier batch get none either and change nothing. A player of whom nothing has come for ``keep`` is evicted by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from touchline.sources import constants
from touchline.streaming.possessions import KEEP

PLAYER = ["match_id", "person_id"]
SECTION = "game_section"


class LastValue(StatefulProcessor):
    """State of one player: its newest frame and value."""

    def __init__(self, value: str, columns: list[str], max_gap: int, keep: int):
        self.value, self.columns, self.max_gap, self.keep = value, columns, max_gap, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "frame_id long, value double", self.keep)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows), ignore_index=True).sort_values("frame_id", kind="stable")
        frame, value = arrived["frame_id"].to_numpy(), arrived[self.value].to_numpy(dtype=np.float64)
        last_frame, last_value = self.newest.get() if self.newest.exists() else (None, None)
        fresh = np.ones(len(frame), dtype=bool) if last_frame is None else frame > last_frame
        before_frame, before = np.append(np.nan, frame[:-1].astype(np.float64)), np.append(np.nan, value[:-1])
        begin = int(np.argmax(fresh)) if fresh.any() else len(frame)
        if begin < len(frame):
            before_frame[begin] = np.nan if last_frame is None else last_frame
            before[begin] = np.nan if last_value is None else last_value
            self.newest.update((int(frame[-1]), None if np.isnan(value[-1]) else float(value[-1])))
        near = fresh & (frame - before_frame <= self.max_gap)
        previous = pd.Series(np.where(near, before, np.nan), index=arrived.index).astype(object)
        made = arrived[self.columns].astype(object).assign(**{f"prev_{self.value}": previous})
        yield made.where(made.notna(), None)

    def close(self) -> None:
        pass


def lagged_stream(rows: DataFrame, value: str = "ball_distance", max_gap: int = constants.FRAME_GAP_RESET, keep: int = KEEP) -> DataFrame:
    """The rows with ``prev_<value>``; rows without a person have no history and are left out. Needs Spark's RocksDB state provider."""
    known = rows.filter("match_id IS NOT NULL AND person_id IS NOT NULL AND frame_id IS NOT NULL")
    fields = ", ".join(f"{name} {kind}" for name, kind in known.dtypes) + f", prev_{value} double"
    # Halves may share frame numbers.
    half = [SECTION] if SECTION in known.columns else []
    return known.groupBy(*PLAYER, *half).transformWithStateInPandas(
        LastValue(value, known.columns, max_gap, keep), fields, "Append", "ProcessingTime"
    )
