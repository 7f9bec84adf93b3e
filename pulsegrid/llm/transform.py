"""Burrows-Wheeler transform and common prefixes of a collection of strings, column by column.

Round j inserts, for every string of j symbols or more, the symbol in front of its last j. The transform so far
lies in a file, ordered by suffix and so in one segment per first symbol; a round reads it from front to
back and writes the next one, with the lengths of the prefixes that neighbours share in a second
file. Memory holds a segment, or several small ones, and a few numbers a string.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np

#: Stands in the transform for "no symbol in front"; never a byte of UTF-8.
END = 0xFF
#: Shared prefixes are counted up to here.
MOST = 250


#: Small segments are read together, up to so many symbols: their number, a symbol and a place are 32 bits.
TOGETHER = 1 << 16
_PLACES = np.arange(TOGETHER, dtype=np.uint32)


def _least(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Least value in each of [start, stop); starts and stops ascend and lie before the end of `values`."""
    if not starts.size:
        return np.zeros(0, np.int64)
    bounds = np.empty(2 * starts.size, np.int64)
    bounds[::2], bounds[1::2] = starts, stops
    return np.minimum.reduceat(values, bounds)[::2].astype(np.int64)


def _together(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """[i, j) of the segments that are read together: up to TOGETHER symbols and 256 segments, or one alone."""
    i, held = 0, 0
    for j, size in enumerate(sizes.tolist()):
        if j > i and (held + size > TOGETHER or j - i == 256):
            yield i, j
            i, held = j, 0
        held += size
    yield i, sizes.size


class Collection:
    """Strings (concatenated bytes without END, and their lengths) and the two files of the transform."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray):
        self.data, self.sizes = data, sizes
        self.ends = np.cumsum(sizes)
        self.lengths = np.zeros(257, np.int64)  # of the segments: empty suffixes, then by first symbol
        self.symbols, self.shared = self._files()
        self._build()

    def _files(self) -> tuple[BinaryIO, BinaryIO]:
        return tempfile.TemporaryFile(), tempfile.TemporaryFile()

    def close(self) -> None:
        self.symbols.close()
        self.shared.close()

    def _read(self, file: BinaryIO, n: int) -> np.ndarray:
        return np.frombuffer(file.read(n), np.uint8)

    def _in_front(self, strings: np.ndarray, length: int) -> np.ndarray:
        """The symbol in front of the last `length` of strings, END where there is none."""
        whole = self.sizes[strings] == length
        at = self.ends[strings] - length - 1
        return np.where(whole, END, self.data[np.where(whole, 0, at)] if self.data.size else END).astype(np.uint8)

    def _build(self) -> None:
        strings = np.arange(self.sizes.size)
        # suffixes to insert: string, segment, place in the segment when all are in, prefix shared with
        # the suffix before and with the one behind
        new = (strings, np.zeros(strings.size, np.int64), strings, *(np.zeros((2, strings.size), np.int64)))
        length = 0
        while new[0].size:
            new = self._round(new, length)
            length += 1

    def _round(self, new: tuple[np.ndarray, ...], length: int) -> tuple[np.ndarray, ...]:
        """Insert suffixes of `length`; returns what is to be inserted next."""
        strings, segment, place, before, behind = new
        bounds = np.searchsorted(segment, np.arange(258))
        symbol = self._in_front(strings, length)
        held = np.zeros(256, np.int64)  # symbols in the segments passed, by symbol
        files = self._files()
        self.symbols.seek(0)
        self.shared.seek(0)
        found = []
        grown = self.lengths + np.diff(bounds)
        for i, j in _together(grown):
            mine = slice(bounds[i], bounds[j])
            old, prefixes = (self._read(f, int(self.lengths[i:j].sum())) for f in (self.symbols, self.shared))
            starts = np.append(0, np.cumsum(grown[i:j]))
            n = int(starts[-1])
            of = segment[mine] - i
            at = place[mine] + starts[of]
            now, lengths = old, prefixes
            if at.size:
                is_old = np.ones(n, bool)
                is_old[at] = False
                # one more at the end, so that bounds of a range may lie behind the last
                now, lengths = np.empty(n, np.uint8), np.zeros(n + 1, np.uint8)
                now[is_old], lengths[:n][is_old] = old, prefixes
                now[at] = symbol[mine]
                # a suffix behind a new one shares with it; where that is new too, its own value is the same
                lengths[at + 1] = behind[mine]
                lengths[at] = before[mine]
                lengths[starts] = 0
                found.append(self._next(now, lengths, at, of, symbol[mine], strings[mine], held, grown[i:j]))
            else:
                held += np.bincount(now, minlength=256)
            files[0].write(now)
            files[1].write(lengths[:n])
        self.lengths = grown
        self.close()
        self.symbols, self.shared = files
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        # segments lie in order of their symbol, places in a segment ascend already
        order = np.argsort(columns[1], kind="stable")
        return tuple(c[order] for c in columns)

    def _next(self, now, lengths, at, of, symbol, strings, held, sizes) -> tuple[np.ndarray, ...]:
        """For the new suffixes of some segments (`of`): the suffixes one symbol longer, and where they go. Adds the segments' symbols to `held`."""
        # the places of each segment, ordered by symbol
        kind, bits = (np.uint32, 16) if now.size <= TOGETHER else (np.uint32, 24) if now.size < 1 << 24 else (np.uint64, 40)
        ordered = now.astype(kind)
        if sizes.size > 1:
            ordered |= np.repeat(np.arange(sizes.size, dtype=kind) << kind(8), sizes)
        counts = np.bincount(ordered, minlength=256 * sizes.size)
        ordered <<= kind(bits)
        ordered |= _PLACES[:now.size] if now.size <= _PLACES.size else np.arange(now.size, dtype=kind)
        ordered.sort()
        mask = kind((1 << bits) - 1)
        starts = np.cumsum(counts) - counts
        by_segment = counts.reshape(-1, 256)
        passed = np.cumsum(by_segment, axis=0) - by_segment + held
        goes = symbol != END
        at, of, symbol, strings = at[goes], of[goes], symbol[goes], strings[goes]
        both = of << 8 | symbol
        rank = np.searchsorted(ordered, both.astype(kind) << kind(bits) | at.astype(kind))
        first, last = rank == starts[both], rank + 1 == starts[both] + counts[both]
        # neighbours with the same symbol in the same segment; beyond it suffixes differ in their first symbol
        before, behind = np.ones(at.size, np.int64), np.ones(at.size, np.int64)
        previous = (ordered[rank[~first] - 1] & mask).astype(np.int64)
        before[~first] = 1 + _least(lengths, previous + 1, at[~first] + 1)
        following = (ordered[rank[~last] + 1] & mask).astype(np.int64)
        behind[~last] = 1 + _least(lengths, at[~last] + 1, following + 1)
        place = passed[of, symbol] + rank - starts[both]
        held += by_segment.sum(axis=0)
        return strings, symbol.astype(np.int64) + 1, place, np.minimum(before, MOST), np.minimum(behind, MOST)

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """The whole transform, and the prefix that each suffix shares with the one before."""
        total = int(self.lengths.sum())
        self.symbols.seek(0)
        self.shared.seek(0)
        return self._read(self.symbols, total), self._read(self.shared, total)

    def ranks(self, least: int):
        """(length, strings, places of their suffixes of that length) for all lengths from `least` on."""
        symbols, _ = self.arrays()
        order = np.argsort(symbols, kind="stable")
        to = np.empty(symbols.size, np.int64)
        to[order] = np.arange(symbols.size) + self.sizes.size  # the empty suffixes come first
        strings, at, length = np.arange(self.sizes.size), np.arange(self.sizes.size), 0
        while strings.size:
            if length >= least:
                yield length, strings, at
            more = self.sizes[strings] > length
            strings, at, length = strings[more], to[at[more]], length + 1


def least_ids(data: np.ndarray, sizes: np.ndarray, ids: np.ndarray, width: int) -> np.ndarray:
    """For every window of `width` symbols of every string, the least id of the strings that hold it.

    Windows in order of the strings and of their starts; strings are at least `width` long.
    """
    collection = Collection(data, sizes)
    try:
        _, shared = collection.arrays()
        run = np.cumsum(shared < width) - 1
        least = np.full(int(run[-1]) + 1 if run.size else 0, np.iinfo(np.int64).max)
        windows = sizes - width + 1
        ends = np.cumsum(windows)
        found = np.empty(int(windows.sum()), np.int64)
        for length, strings, at in collection.ranks(width):
            runs = run[at]
            np.minimum.at(least, runs, ids[strings])
            # a suffix of the window's width starts in the last window
            found[ends[strings] - 1 - (length - width)] = runs
        return least[found]
    finally:
        collection.close()
