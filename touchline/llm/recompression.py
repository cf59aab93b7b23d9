"""Substring deduplication by recompression.

A window is ``WINDOW`` consecutive words ``[^\\x20\\x09-\\x0D]+`` of one document. Each word that is covered by a window whose word sequence also
starts earlier (smaller ``doc_id``, or the same document and an earlier start) is removed; windows are judged on the input.

Rounds. Each document is a string of symbols, at first its words. A round names every run of equal symbols, then deals the symbols
to a left and a right side by a bit of their name and names every left-right pair of neighbours. Names are 64-bit mixes of the parts,
the round and the run length, so they are global without being exchanged: equal substrings get equal names in every task. A symbol depends on a little
context only; its *span* is the stretch of words that fixes it, and every occurrence of the span has the same symbol at the same
place. Runs and pairs at the end of a document have no span, since a copy may go on there.

Anchors. Equal windows hold the same spans. A window's anchor is the span inside it with the smallest hash, of the highest round that
has one (round 0 always has: the words). The windows of one anchor are shuffled together, keyed by the hash of all words of the span: equal
windows meet under one key, different texts under one key only where they share the span. There windows are compared by ``SENT`` bytes of
their hash, in order of document and place, one key at a time; the first is a source, the later are likely repeats. Windows repeated within a task's
chunk are settled there by 64 bits, so what is frequent is sent about once for each chunk. Both come back to their documents as ranges.

Verification. The short hash only proposes. Stretches of likely repeats with one source document and distance are hashed again from their words, by 128 bits of
BLAKE2, and compared with the same stretch of the source. Where they differ, their windows are hashed one by one: those without a source among their
equals had met a different text, so their first stays and the others are repeats of it.

Hot keys. A passage that very many documents hold brings all the different windows around it under one key. Keys of more than ``HOT`` windows, as
counted over one document in ``EVERY``, are not used: their windows are sent one by one, each under a key of its own hash, so that equal windows still
meet and a hot key spreads over all tasks. The count only chooses between the two ways; both give the same repeats.

Memory: a task holds some megabytes of text, or one document; the distinct windows of one key that is not hot; the list of hot keys. A null or short text has no
window and loses nothing. A null ``doc_id`` comes last in the order; rows of one id and different texts follow each other by a hash;
rows repeated with id and text are one document and all reported alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.words import Words, in_chunks, mixed, windows

WINDOW = 20
ROUNDS = 2
#: Bytes of a window's hash that travel; windows of one key that agree in them are verified.
SENT = 5
#: What a range of windows is: settled within its chunk, likely repeated, or what such ones were taken for.
SETTLED, LIKELY, SOURCE = range(3)
#: Different windows whose digests a task holds before it sends them.
HELD = 1 << 17
_ODD = [int(x) | 1 for x in mixed(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))]

#: Windows of a key from which on each is sent under its own hash, and the share of the documents that are looked at to find such keys.
HOT = 20_000
EVERY = 64


class Symbols(NamedTuple):
    """Symbols of consecutive documents with the words ``[low, high)`` of their spans; a span beyond its document is none."""

    names: np.ndarray
    low: np.ndarray
    high: np.ndarray
    document: np.ndarray


def compressed(symbols: Symbols, begin: np.ndarray, end: np.ndarray, turn: int) -> Symbols:
    """One round: runs, then pairs. ``begin`` and ``end`` are the word bounds of the documents."""
    return _pairs(_runs(symbols, begin, end, turn), begin, end, turn)


def _neighbours(s: Symbols, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which symbols begin and end a document, and the span ends that the symbols before and after reach."""
    opens = np.ones(len(s.names), dtype=bool)
    opens[1:] = s.document[1:] != s.document[:-1]
    closes = np.append(opens[1:], True)
    before = np.where(opens, begin[s.document] - 1, np.append(0, s.low[:-1]))
    after = np.where(closes, end[s.document] + 1, np.append(s.high[1:], 0))
    return opens, closes, before, after


def _runs(s: Symbols, begin: np.ndarray, end: np.ndarray, turn: int) -> Symbols:
    opens, _, before, after = _neighbours(s, begin, end)
    starts = np.ones(len(s.names), dtype=bool)
    starts[1:] = opens[1:] | (s.names[1:] != s.names[:-1])
    first = np.flatnonzero(starts)
    last = np.append(first[1:], len(s.names)) - 1
    names, length = s.names[first].copy(), last - first + 1
    long = length > 1
    names[long] = mixed(names[long] * np.uint64(_ODD[3 * turn]) + length[long].astype(np.uint64))
    return Symbols(names, before[first], after[last], s.document[first])


def _pairs(s: Symbols, begin: np.ndarray, end: np.ndarray, turn: int) -> Symbols:
    opens, closes, before, after = _neighbours(s, begin, end)
    left = mixed(s.names + np.uint64(_ODD[3 * turn + 1])) >> np.uint64(63) == 0
    joins = np.zeros(len(s.names), dtype=bool)
    joins[:-1] = left[:-1] & ~left[1:] & ~closes[:-1]
    joined = np.append(False, joins[:-1])
    # A left symbol is known to stay alone from the one after it, a right symbol from the one before.
    low = np.where(left, s.low, before)
    high = np.where(left, after, s.high)
    one = np.flatnonzero(joins)
    names = s.names.copy()
    names[one] = mixed(names[one] * np.uint64(_ODD[3 * turn + 2]) + s.names[one + 1])
    low[one], high[one] = s.low[one], s.high[one + 1]
    stays = ~joined
    return Symbols(names[stays], low[stays], high[stays], s.document[stays])


class Smallest:
    """Place of the smallest value in ranges, the first of equal ones, by minima over powers of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [(values >> np.uint64(32) << np.uint64(32)) | np.arange(len(values), dtype=np.uint64)]

    def place(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        power = np.frexp(np.maximum(high - low, 1))[1] - 1
        while len(self.levels) <= power.max(initial=0):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))
        found = np.empty(len(low), dtype=np.uint64)
        for level in np.unique(power):
            rows = power == level
            table = self.levels[level]
            found[rows] = np.minimum(table[low[rows]], table[high[rows] - (1 << int(level))])
        return (found & np.uint64(0xFFFFFFFF)).astype(np.int64)


def anchors(hashes: np.ndarray, first: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window start the key of its anchor and a number that tells neighbouring anchors apart."""
    begin, end = first[:-1], first[1:]
    document = np.repeat(np.arange(len(begin)), end - begin)
    place = np.arange(len(hashes))
    levels = [Symbols(hashes, place, place + 1, document)]
    for turn in range(ROUNDS):
        levels.append(compressed(levels[-1], begin, end, turn))
    base = np.full(len(hashes) + 1, _ODD[-1], dtype=np.uint64)
    base[0] = 1
    power = np.cumprod(base, dtype=np.uint64)
    base[1:] = pow(_ODD[-1], -1, 2**64)
    inverse = np.cumprod(base, dtype=np.uint64)
    sums = np.append(np.uint64(0), np.cumsum(hashes * power[:-1], dtype=np.uint64))
    keys, number = np.empty(len(starts), dtype=np.uint64), np.empty(len(starts), dtype=np.int64)
    open_rows = np.arange(len(starts))
    for level in range(ROUNDS, -1, -1):
        s = levels[level]
        at = starts[open_rows]
        low, high = np.searchsorted(s.low, at), np.searchsorted(s.high, at + WINDOW, "right")
        has = high > low
        rows, low, high = open_rows[has], low[has], high[has]
        open_rows = open_rows[~has]
        if not len(rows):
            continue
        lows, highs = np.maximum(s.low, 0), np.minimum(s.high, len(hashes))
        names = mixed((sums[highs] - sums[lows]) * inverse[lows] + np.uint64(_ODD[40 + level]))
        chosen = Smallest(names).place(low, high)
        keys[rows], number[rows] = names[chosen], chosen * (ROUNDS + 1) + level
    return keys, number


def _chunk_rows(words: Words, order: np.ndarray, node: np.ndarray, size: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows ``key, doc, node, first, count, hashes``; rows with null hashes are settled repeats. ``hot`` keys, sorted, are replaced by windows' own."""
    hashes, first = words.hashes(), words.first
    count = np.maximum(np.diff(first) - WINDOW + 1, 0)
    if not count.sum():
        return
    document = np.repeat(np.arange(len(count)), count)
    offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    starts = first[document] + offset
    prints = windows(hashes, WINDOW)[starts]
    # The first of equal windows stays; rows of the same document and place are the same window.
    _, sample, which = np.unique(prints, return_index=True, return_inverse=True)
    earlier = sample[which]
    repeat = (earlier != np.arange(len(starts))) & ((node[document] != node[document[earlier]]) | (offset != offset[earlier]))
    keys, number = anchors(hashes, first, starts)
    spread = np.flatnonzero(np.isin(keys, hot))
    keys[spread] = mixed(prints[spread] + np.uint64(_ODD[51]) * keys[spread])
    number[spread] = -2 - spread
    number[repeat] = -1
    cut = np.ones(len(starts), dtype=bool)
    cut[1:] = (document[1:] != document[:-1]) | (number[1:] != number[:-1])
    low = np.flatnonzero(cut)
    high = np.append(low[1:], len(starts))
    settled = repeat[low]
    sent = np.ascontiguousarray(prints.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()
    blobs = [None if s else sent[a * size : b * size] for a, b, s in zip(low.tolist(), high.tolist(), settled.tolist(), strict=True)]
    key = np.where(settled, node[document[low]], keys[low].view(np.int64))
    columns = [key, order[document[low]], node[document[low]], offset[low].astype(np.int32), (high - low).astype(np.int32)]
    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(blobs, pa.binary())], ["key", "doc", "node", "first", "count", "hashes"])


def _anchored(texts: DataFrame, size: int, hot: np.ndarray) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.sort_by([("doc", "ascending"), ("node", "ascending")])
            order, node = batch.column("doc").to_numpy(), batch.column("node").to_numpy()
            for words in in_chunks(batch.column("text")):
                yield from _chunk_rows(words, order[words.rows], node[words.rows], size, hot)

    return texts.mapInArrow(task, "key long, doc long, node long, first int, count int, hashes binary")


def _ranges(node: np.ndarray, at: np.ndarray, source: np.ndarray, source_at: np.ndarray) -> pa.RecordBatch:
    """Ranges of consecutive windows with consecutive sources."""
    cut = np.ones(len(node), dtype=bool)
    cut[1:] = (node[1:] != node[:-1]) | (at[1:] != at[:-1] + 1) | (source[1:] != source[:-1]) | (source_at[1:] != source_at[:-1] + 1)
    low = np.flatnonzero(cut)
    last = np.append(low[1:], len(node)) - 1
    return _ranges_batch(node[low], at[low], at[last], LIKELY, source[low], source_at[low])


def _ranges_batch(node, first, last, kind: int, source=None, source_at=None) -> pa.RecordBatch:
    none = np.zeros(len(node), np.int64)
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
    columns = [node, first, last, none + kind, none if source is None else source, none if source_at is None else source_at]
    arrays = [pa.array(np.asarray(c).astype(t.to_pandas_dtype()), t) for c, t in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["node", "first", "last", "kind", "source", "source_at"])


def _compared(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and place, the windows that an earlier one under the same key seems to equal."""
    held_key, held = None, {}
    for batch in batches:
        settled = batch.column("hashes").is_null().to_numpy(zero_copy_only=False)
        columns = {c: batch.column(c).to_numpy() for c in ("key", "node", "first", "count")}
        done = {c: v[settled] for c, v in columns.items()}
        if settled.any():
            yield _ranges_batch(done["node"], done["first"], done["first"] + done["count"] - 1, SETTLED)
        key, node, first, count = (v[~settled] for v in columns.values())
        if not len(key):
            continue
        sent = np.frombuffer(b"".join(v.as_py() for v in batch.column("hashes") if v.is_valid), np.uint8).reshape(-1, size)
        prints = np.zeros((len(sent), 8), dtype=np.uint8)
        prints[:, :size] = sent
        row = np.repeat(np.arange(len(key)), count)
        at = (first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)).astype(np.int32)
        prints = mixed(prints.view(np.uint64).ravel() * np.uint64(_ODD[50]) + key[row].view(np.uint64))
        _, sample, which = np.unique(prints, return_index=True, return_inverse=True)
        earlier = sample[which]
        repeat = (earlier != np.arange(len(row))) & ((node[row] != node[row[earlier]]) | (at != at[earlier]))
        source, source_at = node[row[earlier]], at[earlier]
        # The batch may go on with the key that the last one ended with.
        for i in np.flatnonzero(key[row] == held_key).tolist() if held_key is not None else ():
            known = held.get(int(prints[i]))
            if known is not None:
                source[i], source_at[i] = known
                repeat[i] = known != (int(node[row[i]]), int(at[i]))
        if held_key != key[-1]:
            held_key, held = key[-1], {}
        for i in np.flatnonzero((key[row] == held_key) & (earlier == np.arange(len(row)))).tolist():
            held.setdefault(int(prints[i]), (int(node[row[i]]), int(at[i])))
        if repeat.any():
            yield _ranges(node[row][repeat], at[repeat], source[repeat], source_at[repeat])


def hot_keys(texts: DataFrame, hot: int = HOT, every: int = EVERY) -> np.ndarray:
    """Keys of more than about ``hot`` windows, sorted."""
    some = texts.where(F.pmod("node", F.lit(every)) == 0)
    rows = _anchored(some, SENT, np.empty(0, dtype=np.uint64)).where("hashes is not null")
    found = rows.groupBy("key").agg(F.sum("count").alias("n")).where(F.col("n") * every > hot).select("key").collect()
    return np.sort(np.array([row[0] for row in found], dtype=np.int64).view(np.uint64))


def repeats(texts: DataFrame, size: int = SENT, hot: int = HOT, every: int = EVERY) -> DataFrame:
    """``node, first, last, kind, source, source_at``: ranges of windows of each document that occur earlier, if likely only there in the document ``source``."""
    rows = _anchored(texts, size, hot_keys(texts, hot, every)).repartition("key").sortWithinPartitions("key", "doc", "node", "first")
    return rows.mapInArrow(lambda batches: _compared(batches, size), "node long, first int, last int, kind int, source long, source_at int")


def _pieces(ranges: pa.Scalar) -> np.ndarray:
    """Different rows ``first, last, kind, ...`` of a document's list, in order."""
    if not ranges.is_valid or not len(ranges.values):
        return np.empty((0, 3), dtype=np.int64)
    fields = range(ranges.values.type.num_fields)
    return np.unique(np.stack([ranges.values.field(i).to_numpy().astype(np.int64) for i in fields], axis=1), axis=0)


class Line:
    """A text's words with single spaces, and digests of its stretches."""

    def __init__(self, text: str):
        words = text.encode().split()
        self.line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        self.starts, self.ends = np.append(0, ends[:-1] + 1).tolist(), ends.tolist()

    def digest(self, first: int, last: int) -> bytes:
        """Of the words under the windows from ``first`` to ``last``."""
        if last + WINDOW > len(self.ends):
            return b""
        return blake2b(self.line[self.starts[first] : self.ends[last + WINDOW - 1]], digest_size=16).digest()


def _claims(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``source, source_at, count, digest, claimant, first``: stretches of likely repeats and what their source must hold."""
    for batch in batches:
        rows = []
        for text, ranges, node in zip(batch.column("text"), batch.column("ranges"), batch.column("node").to_pylist(), strict=True):
            likely = _pieces(ranges)
            likely = likely[likely[:, 2] == LIKELY]
            if not len(likely):
                continue
            first, last, source, at = (likely[:, i] for i in (0, 1, 3, 4))
            cut = np.ones(len(first), dtype=bool)
            cut[1:] = (first[1:] != last[:-1] + 1) | (source[1:] != source[:-1]) | (at[1:] - first[1:] != at[:-1] - first[:-1])
            low = np.flatnonzero(cut)
            last = last[np.append(low[1:], len(cut)) - 1].tolist()
            line = Line(text.as_py())
            for a, z, s, p in zip(first[low].tolist(), last, source[low].tolist(), at[low].tolist(), strict=True):
                rows.append((s, p, z - a + 1, line.digest(a, z), node, a))
        if rows:
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int32())
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["source", "source_at", "count", "digest", "claimant", "first"])


def _refuted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, first, last, kind``: both sides of the claims that do not hold."""
    for batch in batches:
        rows = []
        for text, claims, node in zip(batch.column("text"), batch.column("claims"), batch.column("node").to_pylist(), strict=True):
            line, known = Line(text.as_py()), {}
            for at, count, digest, claimant, first in zip(*(claims.values.field(i).to_pylist() for i in range(5)), strict=True):
                if (at, count) not in known:
                    known[at, count] = line.digest(at, at + count - 1)
                if known[at, count] != digest:
                    rows += [(claimant, first, first + count - 1, LIKELY), (node, at, at + count - 1, SOURCE)]
        if rows:
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["node", "first", "last", "kind"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``a, b, doc, node, first, source``: 128-bit hashes of the windows to verify, in a task's stretch of rows once at their first place."""
    schema = pa.schema([(c, pa.int64()) for c in ("a", "b", "doc", "node")] + [("first", pa.int32()), ("source", pa.bool_())])
    held: dict[bytes, list] = {}

    def made() -> pa.RecordBatch:
        halves = np.frombuffer(b"".join(held), dtype=np.int64).reshape(-1, 2)
        rest = zip(*held.values(), strict=True)
        batch = pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), *(pa.array(c, t.type) for c, t in zip(rest, list(schema)[2:], strict=True))], schema=schema)
        held.clear()
        return batch

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("doc", "node")]
        for text, ranges, doc, node in zip(batch.column("text"), batch.column("ranges"), *columns, strict=True):
            wanted = _pieces(ranges)
            if not len(wanted):
                continue
            line = Line(text.as_py())
            for first, last, kind in wanted.tolist():
                for i in range(first, last + 1):
                    digest = line.digest(i, i)
                    place = (doc, node, i)
                    known = held.get(digest)
                    if known is None:
                        held[digest] = (*place, kind == SOURCE)
                    elif place < known[:3] or kind == SOURCE:
                        held[digest] = (*min(place, known[:3]), known[3] or kind == SOURCE)
                if len(held) >= HELD:
                    yield made()
    if held:
        yield made()


def _unfounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by hash, sources and place, the first window of each hash that has no source."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (batch.column(c).to_numpy() for c in "ab")
        opens = np.ones(len(a), dtype=bool)
        opens[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        opens[0] = before != (a[0], b[0])
        before = a[-1], b[-1]
        missed = pa.array(opens & ~batch.column("source").to_numpy(zero_copy_only=False))
        yield batch.select(["node", "first"]).filter(missed)


def _kept(text: str | None, ranges: np.ndarray, spared: list[int]) -> tuple[int, int, bytes]:
    words = (text or "").encode().split()
    if not len(ranges):
        return len(words), 0, b" ".join(words)
    step = np.zeros(len(words) + 1, dtype=np.int32)
    np.add.at(step, ranges[:, 0], 1)
    np.add.at(step, ranges[:, 1] + 1, -1)
    repeat = np.cumsum(step) > 0
    repeat[spared] = False
    starts = np.flatnonzero(repeat)
    step = np.zeros(len(words) + 1, dtype=np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + WINDOW, -1)
    stays = np.cumsum(step[:-1]) == 0
    kept = b" ".join([words[i] for i in np.flatnonzero(stays).tolist()])
    return len(words), int(len(words) - stays.sum()), kept


def deduplicated(docs: DataFrame, size: int = SENT) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_text``."""
    last = F.lit(2**63 - 1)
    texts = docs.select("doc_id", F.coalesce("doc_id", last).alias("doc"), F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("node"), "text")
    found = repeats(texts.select("doc", "node", "text"), size)
    lists = found.groupBy("node").agg(F.collect_list(F.struct("first", "last", "kind", "source", "source_at")).alias("ranges"))
    # The texts always come with all columns, so that all joins read one exchange.
    joined = texts.join(lists, "node", "left").select("doc_id", "doc", "node", "text", "ranges")
    claims = joined.mapInArrow(_claims, "source long, source_at int, count int, digest binary, claimant long, first int")
    claims = claims.groupBy(F.col("source").alias("node")).agg(F.collect_list(F.struct("source_at", "count", "digest", "claimant", "first")).alias("claims"))
    held = texts.join(claims, "node").select("doc_id", "doc", "node", "text", "claims")
    refuted = held.mapInArrow(_refuted, "node long, first int, last int, kind int").groupBy("node").agg(F.collect_list(F.struct("first", "last", "kind")).alias("ranges"))
    again = texts.join(refuted, "node").select("doc_id", "doc", "node", "text", "ranges")
    hashed = again.mapInArrow(_digests, "a long, b long, doc long, node long, first int, source boolean")
    ordered = hashed.repartition("a", "b").sortWithinPartitions("a", "b", F.desc("source"), "doc", "node", "first")
    spared = ordered.mapInArrow(_unfounded, "node long, first int").groupBy("node").agg(F.collect_list("first").alias("spared"))
    whole = joined.join(spared, "node", "left").select("doc_id", "doc", "text", "ranges", "spared")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows = []
                for text, ranges, spared in zip(part.column("text"), part.column("ranges"), part.column("spared"), strict=True):
                    rows.append(_kept(text.as_py(), _pieces(ranges), spared.as_py() or []))
                n, removed, kept = zip(*rows, strict=True)
                columns = [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array([k.decode() for k in kept], pa.string())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", "n_words", "n_removed", "kept_text"])

    return whole.mapInArrow(task, "doc_id long, n_words long, n_removed long, kept_text string")


def digests(docs: DataFrame, size: int = SENT) -> DataFrame:
    """The same with ``kept_sha256`` in the place of the text."""
    kept = deduplicated(docs, size)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))

