"""Similar sets of words within a group of rows that fits a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pairs, and words of pairs, that are looked at at once.
SPAN = 2**19


def _expanded(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i, ``count[i]`` times i, and the numbers from ``first[i]`` on beside it."""
    of = np.repeat(np.arange(len(count)), count)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + first[of]


def _cuts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most SPAN in all, or of one row."""
    ends, first = np.concatenate([[0], np.cumsum(sizes)]), 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + SPAN, "right")) - 1)
        yield first, last
        first = last


class Sets:
    """The sets of a table's rows, one list of words each without repeats; only those of one ``by`` meet.

    Words are numbered from the rarest on. Of two sets that share enough, the rarest shared word is among so many of the rarest
    of the smaller one that without them too few are left, and in the larger one as many as must be shared stand from it on."""

    def __init__(self, table: pa.Table, similar: float):
        lists = table["tokens"].combine_chunks()
        by = table["by"].combine_chunks().dictionary_encode().indices.to_numpy()
        self.similar, self.size = similar, pc.list_value_length(lists).to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(by)), self.size)
        code = lists.flatten().dictionary_encode().indices.to_numpy().astype(np.int64) * (by.max(initial=0) + 1) + by[row]
        _, word, often = np.unique(code, return_inverse=True, return_counts=True)
        order = np.argsort(often, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        self.words = max(len(order), 1)
        self.keys = np.sort(row * self.words + rank[word])
        self.row, self.word = np.divmod(self.keys, self.words)
        self.first = np.cumsum(self.size) - self.size
        self.at = np.arange(len(self.row)) - self.first[self.row]
        self.need = np.ceil(self.size * similar - 1e-9).astype(np.int64)
        self.often, self.start = often[order], np.cumsum(often[order]) - often[order]
        self.under = np.argsort(self.word, kind="stable")  # the places of each word
        # 256 bits of each set's words: each of one set that the other lacks is a word that it lacks
        mixed = (self.word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)
        bit = np.uint64(1) << (mixed & np.uint64(63))
        self.bits = np.stack([np.bitwise_or.reduceat(np.where(mixed >> np.uint64(6) == i, bit, np.uint64(0)), self.first) for i in range(4)], 1) if len(self.row) else np.empty((0, 4), np.uint64)

    def pairs(self, side: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, row, similarity) of similar sets, each pair once; of rows that differ in ``side``, where that is given."""
        rare = np.flatnonzero((self.at < np.maximum(self.size - self.need + 1, 1)[self.row]) & (self.often[self.word] > 1))
        meets = np.bincount(self.row[rare], self.often[self.word[rare]], len(self.size)).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(np.bincount(self.row[rare], minlength=len(self.size)))])
        for low, high in _cuts(meets):  # whole rows, so a pair does not come again
            own = rare[ends[low] : ends[high]]
            word = self.word[own]
            of, at = _expanded(self.start[word], self.often[word])
            x, place = self.row[own[of]], self.under[at]
            y = self.row[place]
            on = ((self.size[y] > self.size[x]) | ((self.size[y] == self.size[x]) & (y > x))) & (self.size[y] - self.at[place] >= self.need[x])
            if side is not None:
                on &= side[x] != side[y]
            x, y = np.divmod(np.unique(x[on] * len(self.size) + y[on]), max(len(self.size), 1))
            lacks = np.bitwise_count(self.bits[x] & ~self.bits[y]).sum(1, dtype=np.int64)
            on = lacks <= self.size[x] - self.need[x]
            yield from self._shared(x[on], y[on])

    def _shared(self, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for low, high in _cuts(self.size[x]):
            u, v = x[low:high], y[low:high]
            of, at = _expanded(self.first[u], self.size[u])
            asked = v[of] * self.words + self.word[at]
            found = self.keys[np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)] == asked
            share = np.bincount(of, found, len(u)) / self.size[u]
            on = share >= self.similar
            if on.any():
                yield u[on], v[on], share[on]
