"""Burrows-Wheeler transform and common prefixes of a collection of strings, built column by column.

Each round inserts one symbol of every string, from its end to its front: the suffix that
begins there enters the sorted order of all suffixes inserted so far. Where it enters follows from
the transform alone. If the suffix X stands at place p and is preceded by the symbol c,
then cX stands behind all suffixes with a smaller first symbol and behind those suffixes cY
whose Y stands before p; so sorting the transform's symbols (stably) gives the places of
the next round. The common prefix of cX with its neighbour cY is one more than the
smallest common prefix between Y and X. Both columns are sequential files that a round
reads and rewrites once; here they are arrays, because a collection is a bounded batch.
"""

from __future__ import annotations

import numpy as np

_BLOCK = 16


class _RangeMin:
    """Smallest value of any range of an array of bytes: short ranges in full, long ones by block minima."""

    def __init__(self, values: np.ndarray):
        self.values = np.full(-(-len(values) // _BLOCK) * _BLOCK + 2 * _BLOCK, 255, np.uint8)
        self.values[:len(values)] = values
        self.levels: list[np.ndarray] = []

    def _table(self, longest: int):
        """Minima of 1, 2, 4 ... blocks from every block on."""
        if not self.levels:
            least = self.values
            for _ in range(_BLOCK.bit_length() - 1):
                least = np.minimum(least[::2], least[1::2])
            self.levels = [least]
        while 2 << (len(self.levels) - 1) <= longest:
            width = 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(self.levels[-1][:-width], self.levels[-1][width:]))

    def query(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Smallest of values[start:end], for start < end."""
        found = self.values[start]
        rows = np.flatnonzero(end - start > 1)
        if len(rows):
            start, end = start[rows], end[rows]
            last = end - 1
            # the first and the last values of the range, which overlap in a short one
            reach = min(_BLOCK, int((end - start).max()))
            least = self.values[start]
            for step in range(1, reach):
                least = np.minimum(least, self.values[np.minimum(start + step, last)])
            far = np.flatnonzero(end - start > _BLOCK)
            if len(far):
                first, final = start[far] // _BLOCK + 1, end[far] // _BLOCK
                tail = least[far]
                for step in range(_BLOCK):
                    tail = np.minimum(tail, self.values[last[far] - step])
                inner = np.flatnonzero(first < final)
                if len(inner):
                    first, final = first[inner], final[inner]
                    level = np.frexp((final - first).astype(np.float64))[1] - 1
                    self._table(int((final - first).max()))
                    for k in np.unique(level).tolist():
                        own = np.flatnonzero(level == k)
                        table = self.levels[k]
                        middle = np.minimum(table[first[own]], table[final[own] - (1 << k)])
                        tail[inner[own]] = np.minimum(tail[inner[own]], middle)
                least[far] = tail
            found[rows] = least
        return found


def build(strings: np.ndarray, lengths: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """The transform (0 where a string begins, else symbol + 1) and common prefixes, up to `cap`.

    `strings` has one string in each row, aligned to the right; `lengths` are at least 1. The first rows of the
    result belong to the empty suffixes, in the order of the strings. The byte 255 does not occur (it does
    not in UTF-8), `cap` is below 255.
    """
    n, width = strings.shape
    symbols = np.ascontiguousarray((strings + np.uint8(1)).T)  # a column is read in each round
    # both columns in one array: the symbol before the suffix of each length, 0 where the string is
    # used up, and above it the common prefix with the suffix before
    both = symbols[-1].astype(np.uint16)
    alive, places = np.arange(n), np.arange(n)
    for t in range(1, width + 1):
        reach = lengths[alive] >= t
        if not reach.all():
            alive, places = alive[reach], places[reach]
        if not len(alive):
            break
        bwt, common = (both & 255).astype(np.uint8), (both >> 8).astype(np.uint8)
        order = np.argsort(bwt, kind="stable")  # places by symbol, first those where strings begin
        counts = np.bincount(bwt, minlength=1)
        bounds = np.cumsum(counts)
        # in the order of symbol and place, which is that of the new suffixes
        by_symbol = np.argsort(bwt[places], kind="stable")
        alive, places = alive[by_symbol], places[by_symbol]
        own = bwt[places]
        new = np.empty(len(places), np.int64)
        cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            low, high = bounds[own[a] - 1], bounds[own[a]]
            new[a:b] = low + np.searchsorted(order[low:high], places[a:b])
        # common prefixes with the neighbours that begin with the same symbol
        least = _RangeMin(common)
        left, right = np.zeros(len(new), np.uint8), np.zeros(len(new), np.uint8)
        for rows, step, out in (
            (np.flatnonzero(new > bounds[own - 1]), -1, left), (np.flatnonzero(new + 1 < bounds[own]), 1, right),
        ):
            other, place = order[new[rows] + step], places[rows]
            low, high = (other, place) if step < 0 else (place, other)
            out[rows] = np.minimum(least.query(low + 1, high + 1), cap - 1) + 1
        new += n - bounds[0]  # behind the empty suffixes
        grown = np.empty(len(both) + len(new), np.uint16)
        old = np.ones(len(grown), bool)
        old[new] = False
        grown[old] = both
        before = symbols[width - 1 - t, alive] if t < width else np.zeros(len(new), np.uint8)
        before[lengths[alive] <= t] = 0
        grown[new] = before | left.astype(np.uint16) << 8
        after = new + 1
        inside = np.flatnonzero(after < len(grown))
        after = after[inside]
        grown[after] = grown[after] & 255 | right[inside].astype(np.uint16) << 8
        both, places = grown, new
    return (both & 255).astype(np.uint8), (both >> 8).astype(np.uint8)


def places_by_length(bwt: np.ndarray, n: int, width: int) -> np.ndarray:
    """The place of the suffix of each length (column) of each string (row), -1 where there is none."""
    ends = int((bwt == 0).sum())
    order = np.argsort(bwt, kind="stable")[ends:]
    step = np.full(len(bwt), -1, np.int64)
    step[order] = np.arange(len(order)) + n
    found = np.full((n, width + 1), -1, np.int64)
    found[:, 0] = np.arange(n)
    for t in range(1, width + 1):
        before = found[:, t - 1]
        found[:, t] = np.where(before >= 0, step[before], -1)
    return found
