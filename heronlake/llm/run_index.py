"""A run-length compressed index of short byte strings, and matching statistics streamed against it.

The index holds the Burrows-Wheeler transform of the strings, one after another, as runs: for each run its symbol, its
first row, where its first row maps to and in which run that is, and the suffix-array values of its first and last row.
Suffixes are sorted only while the index is built. Every string belongs to a document; rows whose suffixes agree in
their first `length` bytes form a class, of which the first row and the smallest document are kept, and for each run the
class of its first row.

A pattern is streamed from its end to its start. A row stands for a suffix that shares the most bytes with what has
been read. If the row's run holds the pattern's next byte, the row maps on and the match grows by one. Else the nearest
runs of that byte above and below are candidates: no other suffix behind the byte can share more. Their sampled
suffixes are compared with the pattern, the longer match is kept, and its row maps on. Where `length` bytes or more
match, the row's class names the smallest document that holds them. Patterns advance in step, so each step is a few
array operations over all of them.
"""

from __future__ import annotations

import numpy as np

#: Stands behind each string; no UTF-8 text holds this byte.
END = 0xFF


def packed_words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as a little-endian number; data ends with 8 bytes of padding at least."""
    return np.ascontiguousarray(np.ndarray((len(data) - 7,), "<u8", data, 0, (1,)))


class RunIndex:
    def __init__(self, rows: np.ndarray, sizes: np.ndarray, docs: np.ndarray, length: int):
        """rows: a string in the first `sizes` bytes of each; docs: the strings' documents; length: 8 or more."""
        n, width = rows.shape
        flat = np.full((n, width + 1), END, dtype=np.uint8)
        flat[:, :width] = rows
        flat[np.arange(n), sizes] = END
        self.text = flat[np.arange(width + 1) <= sizes[:, None]]
        order, same = self._sorted_suffixes(length)
        total = len(order)
        classes = np.flatnonzero(~same)
        owner = np.repeat(np.arange(n), sizes + 1)
        self.class_first = np.append(classes, total)
        self.class_least = np.minimum.reduceat(docs[owner[order]], classes) if total else docs[:0]
        last = self.text[order - 1]
        new = np.ones(total, dtype=bool)
        new[1:] = last[1:] != last[:-1]
        first = np.flatnonzero(new)
        #: First rows of the runs, and the number of rows behind them.
        self.first = np.append(first, total)
        self.symbol = last[first].astype(np.int64)
        self.class_of_run = np.searchsorted(classes, first, side="right") - 1
        # Sampled run ends.
        self.at_first, self.at_last = order[first], order[self.first[1:] - 1]
        # Runs in the order of (symbol, row): where each begins in the first column.
        self.by_symbol = np.argsort(self.symbol, kind="stable")
        self.key = self.symbol[self.by_symbol] * len(first) + self.by_symbol
        sizes_of = np.diff(self.first)[self.by_symbol]
        self.maps_to = np.empty(len(first), dtype=np.int64)
        self.maps_to[self.by_symbol] = np.cumsum(sizes_of) - sizes_of
        self.to_run = np.searchsorted(first, self.maps_to, side="right") - 1

    def _sorted_suffixes(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order, and whether each shares its first `length` bytes with the one before it.

        Sorted by 8 bytes first; then the length that ties are sorted to doubles.
        """
        size = len(self.text)
        if not size:
            return np.zeros(0, np.int64), np.zeros(0, bool)
        keys = packed_words(np.concatenate([self.text, np.zeros(8, np.uint8)])).byteswap()[:size]
        order = np.argsort(keys)
        keys = keys[order]
        new = np.ones(size, dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        # The rank of a suffix is the first row of those that tie with it; behind the text stands rank -1.
        rank = np.full(size + 2 * length + 8, -1, dtype=np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(size), 0))
        step, level, by_level = 8, 8, rank
        while True:
            if step <= length:
                level, by_level = step, rank.copy()
            alone = new.copy()
            alone[:-1] &= new[1:]
            tied = np.flatnonzero(~alone)
            if not len(tied):
                break
            suffix = order[tied]
            behind = np.where(suffix + step < size, rank[np.minimum(suffix + step, size - 1)], -1)
            pair = rank[suffix] * (size + 1) + behind + 1
            by_pair = np.argsort(pair)
            pair, suffix = pair[by_pair], suffix[by_pair]
            order[tied] = suffix
            fresh = np.ones(len(tied), dtype=bool)
            fresh[1:] = pair[1:] != pair[:-1]
            new[tied] = fresh
            rank[suffix] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(tied)), 0))]
            step *= 2
        rest = length - level
        same = np.zeros(size, dtype=bool)
        a, b = order[1:], order[:-1]
        same[1:] = (by_level[a] == by_level[b]) & (by_level[a + rest] == by_level[b + rest])
        return order, same

    def _common(self, at: np.ndarray, patterns: np.ndarray, begin: int, most: np.ndarray) -> np.ndarray:
        """How many bytes the text from `at` shares with the patterns from column begin, up to `most`."""
        shared, left, step = np.zeros(len(at), dtype=np.int64), np.flatnonzero(most > 0), 0
        while len(left):
            columns = step + np.arange(min(16, int(most[left].max()) - step))
            there = self.text[np.minimum(at[left, None] + columns, len(self.text) - 1)]
            differ = (there != patterns[left, begin + step : begin + step + len(columns)]) | (columns >= most[left, None])
            stop = differ.any(axis=1)
            shared[left] += np.where(stop, differ.argmax(axis=1), len(columns))
            step += len(columns)
            left = left[~stop & (most[left] > step)]
        return shared

    def matching_statistics(self, patterns: np.ndarray, sizes: np.ndarray):
        """From the last column to the first: (column, patterns that reach it, match lengths, rows of the matches, their runs).

        Patterns are in the order of falling sizes; those that reach a column are its first so many.
        """
        m, width = patterns.shape
        row, run, length = (np.zeros(m, dtype=np.int64) for _ in range(3))
        runs = len(self.symbol)
        for i in range(width - 1, -1, -1):
            k = int(np.searchsorted(-sizes, -i, side="left"))
            if not k:
                continue
            symbol, target, at = patterns[:k, i].astype(np.int64), run[:k].copy(), row[:k].copy()
            off = np.flatnonzero(self.symbol[target] != symbol)
            lost = off[:0]
            if len(off):
                place = np.searchsorted(self.key, symbol[off] * runs + target[off])
                up, down = self.by_symbol[np.maximum(place - 1, 0)], self.by_symbol[np.minimum(place, runs - 1)]
                has_up, has_down = (place > 0) & (self.symbol[up] == symbol[off]), (place < runs) & (self.symbol[down] == symbol[off])
                most, here = length[off], patterns[off]
                shared_up = np.where(has_up, self._common(self.at_last[up], here, i + 1, np.where(has_up, most, 0)), -1)
                shared_down = np.where(has_down, self._common(self.at_first[down], here, i + 1, np.where(has_down, most, 0)), -1)
                above = shared_up >= shared_down
                target[off] = np.where(above, up, down)
                at[off] = np.where(above, self.first[up + 1] - 1, self.first[down])
                length[off] = np.maximum(shared_up, shared_down)
                lost = off[~has_up & ~has_down]
            at += self.maps_to[target] - self.first[target]
            target = self.to_run[target]
            at[lost] = target[lost] = 0
            # The row may lie some runs behind the one that its run's first row maps to.
            behind = np.flatnonzero(self.first[target + 1] <= at)
            while len(behind):
                target[behind] += 1
                behind = behind[self.first[target[behind] + 1] <= at[behind]]
            row[:k], run[:k] = at, target
            length[:k] += 1
            yield i, k, length[:k], row[:k], run[:k]

    def least_document(self, rows: np.ndarray, runs: np.ndarray) -> np.ndarray:
        """The smallest document that holds the first `length` bytes of the suffixes of these rows, which lie in these runs."""
        found = self.class_of_run[runs]
        late = np.flatnonzero(self.class_first[found + 1] <= rows)
        found[late] = np.searchsorted(self.class_first, rows[late], side="right") - 1
        return self.class_least[found]
