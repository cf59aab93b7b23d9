"""Words of Arrow text columns as arrays: places and 64-bit hashes, a few megabytes of text at a time.

A word's hash is the sum, passed through a finaliser, of one mixed value for each of its bytes and the byte's place in the word, so no
arrangement of bytes makes sums meet as in polynomials modulo 2**64; every task computes the same one. ``distinct`` compares bytes, too. Texts
are read as UTF-8 bytes, null as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are held as arrays at once; a longer document is taken alone, its words hashed in parts.
CHUNK = 1 << 21

_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


#: Values of a byte at its place in a word; places beyond the table are worked out.
_TABLED = 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _values(place: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return mixed(((place.astype(np.uint64) << np.uint64(8)) + byte + np.uint64(1)) * _STEP)


_VALUES = _values(np.arange(_TABLED)[:, None], np.arange(256, dtype=np.uint64)[None, :]).ravel()
#: Bytes that are hashed at once.
_PART = 1 << 17


class Words(NamedTuple):
    """Words of consecutive documents: those of document ``i`` are ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    rows: slice
    offsets: np.ndarray

    def hashes(self, lower: bool = False) -> np.ndarray:
        found = np.empty(len(self.starts), dtype=np.uint64)
        low = 0
        while low < len(self.starts):
            origin = self.starts[low]
            high = max(low + 1, int(np.searchsorted(self.ends, origin + _PART, "right")))
            stop = self.ends[high - 1]
            data = _LOWER[self.data[origin:stop]] if lower else self.data[origin:stop]
            starts, ends = self.starts[low:high] - origin, self.ends[low:high] - origin
            # Bytes between words get places too, but are in no sum.
            place = np.arange(len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
            far = np.flatnonzero(place >= _TABLED)
            values = _VALUES[np.minimum(place, _TABLED - 1) << 8 | data]
            values[far] = _values(place[far], data[far])
            sums = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(values, out=sums[1:])
            found[low:high] = mixed(sums[ends] - sums[starts])
            low = high
        return found

    def equal(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Whether pairs of words, given by their numbers, hold the same bytes."""
        length = self.ends[one] - self.starts[one]
        same = length == self.ends[other] - self.starts[other]
        rows = np.flatnonzero(same)
        first = np.cumsum(length[rows]) - length[rows]
        inside = np.arange(int(length[rows].sum())) - np.repeat(first, length[rows])
        left, right = (self.data[inside + np.repeat(self.starts[side[rows]], length[rows])] for side in (one, other))
        if len(rows):
            same[rows] = np.logical_and.reduceat(left == right, first)
        return same

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The number of a sample of each distinct word, and for each word which of them it equals, byte for byte."""
        _, sample, which = np.unique(self.hashes(), return_index=True, return_inverse=True)
        odd = np.flatnonzero(~self.equal(np.arange(len(which)), sample[which]))
        # Words that only share their hash with the sample are told apart by their bytes.
        others: dict[bytes, int] = {}
        for i in odd.tolist():
            which[i] = others.setdefault(self.data[self.starts[i] : self.ends[i]].tobytes(), len(sample) + len(others))
        if others:
            made = np.array([odd[np.flatnonzero(which[odd] == n)[0]] for n in others.values()])
            sample = np.concatenate([sample, made])
        return sample, which

    def joined(self, keep: np.ndarray) -> pa.LargeStringArray:
        """The marked words of each document, joined by single spaces."""
        kept = np.flatnonzero(keep)
        length = self.ends[kept] - self.starts[kept]
        first = np.searchsorted(kept, self.first)
        # A space follows each word but the last of its document.
        room = length + 1
        room[first[1:][np.diff(first) > 0] - 1] -= 1
        begin = np.append(0, np.cumsum(room))
        text = np.full(begin[-1], 0x20, dtype=np.uint8)
        inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        text[inside + np.repeat(begin[:-1], length)] = self.data[inside + np.repeat(self.starts[kept], length)]
        buffers = [None, pa.py_buffer(begin[first].astype(np.int64).tobytes()), pa.py_buffer(text.tobytes())]
        return pa.Array.from_buffers(pa.large_string(), len(first) - 1, buffers)


def in_chunks(text: pa.Array, cut=None) -> Iterator[Words]:
    """The words of an Arrow text column, some megabytes of documents at a time; ``cut`` may place words otherwise."""
    cut = cut or spaced
    text = text.fill_null("").cast(pa.large_string())
    rows = len(text)
    if rows == 0:
        return
    _, offsets_buffer, data_buffer = text.buffers()
    offsets = np.frombuffer(offsets_buffer, dtype=np.int64)[text.offset : text.offset + rows + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.empty(0, dtype=np.uint8)
    low = 0
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + CHUNK, "right")) - 1)
        yield cut(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], slice(low, high))
        low = high


def spaced(data: np.ndarray, offsets: np.ndarray, rows: slice) -> Words:
    """Runs of bytes other than white space."""
    return runs(data, offsets, rows, ~_SPACE)


def runs(data: np.ndarray, offsets: np.ndarray, rows: slice, kind: np.ndarray) -> Words:
    """Runs of the bytes that ``kind`` marks."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = kind[data]
    # A word also begins or ends where its document does.
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets), rows, offsets)


_PLACE = mixed(np.arange(1001, 1065, dtype=np.uint64))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each word on; the last ``width - 1`` words begin none."""
    count = max(len(hashes) - width + 1, 0)
    total = np.zeros(count, dtype=np.uint64)
    for j in range(width if count else 0):
        total += hashes[j : j + count] * _PLACE[j % 64]
    return mixed(total)
