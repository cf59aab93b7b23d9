"""Periodic runs of words, found by longest common extensions.

A run is a stretch of consecutive words ``[^\\x20\\x09-\\x0D]+`` with smallest period ``q`` (words ``q`` apart are identical) and a length of at least
``max(LEAST, 2 * q)`` that no neighbouring word extends with the same period. *Collapsing* drops each word that a run contains after
the run's first ``q`` words.

Grid. Under a run of period ``q`` lies a stretch of at least ``g = max(q, LEAST - q)`` places that hold the same word as the place ``q`` on, so one of
``0, g, 2 g, ...`` is among them: all periods of ``n`` words have about ``n * ln n`` such places. From each the common extension of the places ``i`` and
``i + q`` to both sides gives the whole run. Of equal stretches the smallest period is kept; any other is a multiple of it.

Extensions. The words at places whose remainder modulo ``CYCLE`` lies in the difference cover ``COVER`` are samples. Any two places reach two samples
after the same few steps, so some word comparisons either settle an extension or end at samples. Only the suffixes that begin at samples are
sorted (by their first ``CYCLE`` words, then by doubling), and only in documents in which some extension went that far. The
common length of two of them is the least one between neighbours in that order: a range minimum over a sparse table.

Words are compared by their bytes. Every document is judged by itself, in one task, a few megabytes of texts or one long text at
a time, in memory proportional to its words. Null and empty texts have no words and no run; ``collapsed`` is then empty. Repeated rows are judged
alike, a null ``doc_id`` too. An empty table gives an empty result; other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.words import Words, in_chunks

LEAST = 12
#: Every difference modulo ``CYCLE`` occurs between two members of the cover.
CYCLE = 13
COVER = (0, 1, 3, 9)
#: Grid places that are looked at together.
PLACES = 1 << 20
#: Words to either side by which most places are turned down before any suffix is sorted.
FEW = 6

_SAMPLED = np.isin(np.arange(CYCLE), COVER)
#: Steps after which places of two remainders are both samples.
_STEPS = np.array([[next(d for d in range(CYCLE) if _SAMPLED[(a + d) % CYCLE] and _SAMPLED[(b + d) % CYCLE]) for b in range(CYCLE)] for a in range(CYCLE)])


class Runs(NamedTuple):
    """Runs of consecutive documents in order of document, start and period; starts are places among all words of the chunk."""

    document: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _matching(ids: np.ndarray, i: np.ndarray, j: np.ndarray, steps) -> np.ndarray:
    """How many of the first ``steps`` words from ``i`` and ``j`` on are the same, up to the first difference."""
    steps = np.broadcast_to(steps, i.shape)
    same = np.zeros(len(i), dtype=np.int64)
    rows = np.flatnonzero(steps > 0)
    while len(rows):
        at = same[rows]
        rows = rows[ids[i[rows] + at] == ids[j[rows] + at]]
        same[rows] += 1
        rows = rows[same[rows] < steps[rows]]
    return same


class Suffixes:
    """Sampled suffixes of a sequence in order, with the common lengths of neighbours; no two suffixes of the sequence may be equal."""

    def __init__(self, ids: np.ndarray):
        places = np.flatnonzero(_SAMPLED[np.arange(len(ids)) % CYCLE])
        padded = np.append(ids, np.full(CYCLE, -1, dtype=ids.dtype))
        order = np.lexsort([padded[places + k] for k in reversed(range(CYCLE))])
        opens = np.ones(len(places), dtype=bool)
        here, before = places[order[1:]], places[order[:-1]]
        opens[1:] = np.logical_or.reduce([padded[here + k] != padded[before + k] for k in range(CYCLE)])
        number = np.full(len(ids), -1, dtype=np.int64)
        number[places[order]] = np.cumsum(opens)
        self.names = [number]
        width = CYCLE
        while not opens.all():
            number = self.names[-1]
            follows = np.where(places + width < len(ids), number[np.minimum(places + width, len(ids) - 1)], -1)
            order = np.lexsort([follows, number[places]])
            opens[1:] = (np.diff(number[places[order]]) != 0) | (np.diff(follows[order]) != 0)
            number = np.full(len(ids), -1, dtype=np.int64)
            number[places[order]] = np.cumsum(opens)
            self.names.append(number)
            width *= 2
        self.rank = self.names[-1] - 1
        sorted_places = places[order]
        self.minima = [self._neighbours(padded, sorted_places[:-1], sorted_places[1:])]
        while 2 ** len(self.minima) <= len(self.minima[0]):
            last, step = self.minima[-1], 2 ** (len(self.minima) - 1)
            self.minima.append(np.minimum(last[:-step], last[step:]))
        del self.names

    def _neighbours(self, padded: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common lengths of suffixes: by ever narrower names, then by words."""
        length, size = np.zeros(len(i), dtype=np.int64), len(padded) - CYCLE
        for level in reversed(range(len(self.names))):
            names = self.names[level]
            x, y = i + length, j + length
            inside = np.maximum(x, y) < size
            same = np.zeros(len(i), dtype=bool)
            same[inside] = names[x[inside]] == names[y[inside]]
            length[same] += CYCLE << level
        inside = np.flatnonzero(np.maximum(i, j) + length < size)
        length[inside] += _matching(padded, i[inside] + length[inside], j[inside] + length[inside], CYCLE)
        return length

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common lengths of the suffixes at different sampled places."""
        one, other = self.rank[i], self.rank[j]
        low, high = np.minimum(one, other), np.maximum(one, other)
        power = np.frexp(high - low)[1] - 1
        found = np.empty(len(i), dtype=np.int64)
        for level in np.unique(power):
            rows = power == level
            table = self.minima[level]
            found[rows] = np.minimum(table[low[rows]], table[high[rows] - (1 << int(level))])
        return found


class Extensions:
    """Longest common extensions in a sequence without equal suffixes; the samples are sorted when they are first reached."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.suffixes = ids, None

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        steps = _STEPS[i % CYCLE, j % CYCLE]
        length = _matching(self.ids, i, j, steps)
        reached = np.flatnonzero(length == steps)
        if len(reached):
            if self.suffixes is None:
                self.suffixes = Suffixes(self.ids)
            length[reached] += self.suffixes.common(i[reached] + steps[reached], j[reached] + steps[reached])
        return length


def _grid(first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods to look at in documents with the words ``first[d]`` to ``first[d + 1]``."""
    words = np.diff(first)
    most = np.where(words >= LEAST, words // 2, 0)
    document = np.repeat(np.arange(len(words)), most)
    period = np.arange(len(document)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(period, LEAST - period)
    count = (words[document] - period - 1) // step + 1
    total = np.append(0, np.cumsum(count))
    low = 0
    while low < len(document):
        high = max(low + 1, int(np.searchsorted(total, total[low] + PLACES, "right")) - 1)
        part = slice(low, high)
        row = np.repeat(np.arange(low, high), count[part])
        turn = np.arange(total[low], total[high]) - total[row]
        yield first[document[row]] + turn * step[row], period[row]
        low = high


def runs_of(ids: np.ndarray, first: np.ndarray) -> Runs:
    """All runs of documents whose words are numbered ``ids``."""
    document = np.repeat(np.arange(len(first) - 1), np.diff(first))
    # A mark of its own before, between and after documents stops every extension and makes all suffixes different.
    shift = document + 1
    marked = np.empty(len(ids) + len(first), dtype=np.int64)
    marks = first + np.arange(len(first))
    marked[marks] = ids.max(initial=-1) + 1 + np.arange(len(first))
    marked[np.arange(len(ids)) + shift] = ids
    back, end = marked[::-1], len(marked) - 1
    places, periods = [], []
    for place, period in _grid(first):
        near = ids[place] == ids[place + period]
        i, q = place[near] + shift[place[near]], period[near]
        # The stretch must hold enough places; most chance matches end within a few words.
        near = _matching(marked, i, i + q, FEW) + _matching(back, end - i, end - i - q, FEW) > FEW
        places.append(i[near])
        periods.append(q[near])
    i, q = np.concatenate([*places, np.empty(0, np.int64)]), np.concatenate([*periods, np.empty(0, np.int64)])
    if not len(i):
        return Runs(*[np.empty(0, dtype=np.int64)] * 4)
    # Only documents that still have a place are sorted.
    owner = np.searchsorted(marks, i, "right") - 1
    used = np.unique(owner)
    cuts = [np.arange(marks[d], marks[d + 1]) for d in used.tolist()]
    chosen = np.concatenate([*cuts, [end]])
    begin = np.append(0, np.cumsum([len(c) for c in cuts]))[:-1]
    moved = i - marks[owner] + begin[np.searchsorted(used, owner)]
    some = marked[chosen]
    ahead, behind, end = Extensions(some), Extensions(some[::-1].copy()), len(some) - 1
    found = []
    for low in range(0, len(moved), PLACES):
        i, p, d = (c[low : low + PLACES] for c in (moved, q, owner))
        after, before = ahead(i, i + p), behind(end - i, end - i - p)
        length = after + before - 1 + p
        long = length >= np.maximum(LEAST, 2 * p)
        start = chosen[i - before + 1] - 1 - d
        rows = np.stack([d[long], start[long], length[long], p[long]], axis=1)
        found.append(np.unique(rows, axis=0))
    rows = np.unique(np.concatenate(found), axis=0)
    # The first of equal stretches has the smallest period.
    smallest = np.ones(len(rows), dtype=bool)
    smallest[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    d, start, length, period = rows[smallest].T
    order = np.lexsort([period, start, d])
    return Runs(d[order], start[order], length[order], period[order])


def kept_words(runs: Runs, words: int) -> np.ndarray:
    """Which of the words stay when each run is reduced to its first period."""
    step = np.zeros(words + 1, dtype=np.int64)
    np.add.at(step, runs.start + runs.period, 1)
    np.add.at(step, runs.start + runs.length, -1)
    return np.cumsum(step[:-1]) == 0


def _judged(words: Words) -> list[pa.Array]:
    _, ids = words.distinct()
    runs = runs_of(ids, words.first)
    counts = np.bincount(runs.document, minlength=len(words.first) - 1)
    inside = runs.start - words.first[runs.document]
    fields = pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in (inside, runs.length, runs.period)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), fields)
    return [pa.array(np.diff(words.first).astype(np.int64)), lists, words.joined(kept_words(runs, len(ids))).cast(pa.string())]


def collapsed(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, collapsed``; ``runs`` holds ``start, length, period`` in order of start and period."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in in_chunks(batch.column("text")):
                part = batch.column("doc_id").slice(words.rows.start, words.rows.stop - words.rows.start)
                yield pa.RecordBatch.from_arrays([part, *_judged(words)], ["doc_id", "n_words", "runs", "collapsed"])

    kind = dict(docs.dtypes)["doc_id"]
    fields = f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(task, fields)


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the periods of the contract: in one document of ten, word ``i >= a`` becomes word ``a + (i - a) % p``.

    A document without an id, or without words, keeps its text.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g")).withColumn("n", F.size("words").cast("long"))
    some = F.col("n") > 0
    cut = cut.withColumn("a", F.when(some, F.col("g") % F.col("n")))
    cut = cut.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    moved = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    made = F.array_join(F.transform(moved, lambda i: F.get("words", i.cast("int"))), " ")
    return cut.select("doc_id", F.when(some, made).otherwise(F.col("text")).alias("text"))


def digests(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, its longest run, and digests of all runs and of the collapsed text."""
    found = collapsed(planted(docs))
    # Of the longest runs the first, then that of the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    rows = found.withColumns({"best": best, "lines": lines})
    length, period = F.col("best.length"), -F.col("best.period")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
