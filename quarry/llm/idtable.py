"""A table of distinct chunks: each is tokenized once, its ids are put back by position."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

LIMIT = 150_000   # distinct chunks kept per task; the older half goes when they are more


class _Known:
    """Chunks by number, and their ids one after another."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 16, np.int64)   # start[k] .. start[k + 1] are chunk k's ids

    def add(self, chunks: list[str], ids: np.ndarray, lens: np.ndarray) -> None:
        n = len(self.index)
        used = int(self.start[n])
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(chunks) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.flat[used:used + len(ids)] = ids
        self.start[n + 1:n + len(chunks) + 1] = used + np.cumsum(lens)
        self.index.update(zip(chunks, range(n, n + len(chunks)), strict=True))

    def ids_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chunks ``at``, one chunk after another, and their numbers."""
        first = self.start[at]
        lens = self.start[at + 1] - first
        stop = np.cumsum(lens)
        return self.flat[np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(first - (stop - lens), lens)], lens


class IdTable:
    """``learn`` gives the ids of a list of distinct chunks: all in order, and their numbers.

    Chunks are kept in two generations. When the newer one is full it becomes
    the older one, and the chunks of that are dropped unless they come again.
    """

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], fixed: dict[str, list[int]],
                 limit: int = LIMIT):
        self.learn, self.fixed, self.limit = learn, fixed, limit
        self.older = _Known()
        self._begin()

    def _begin(self):
        self.newer = _Known()
        self.newer.add(list(self.fixed), np.array([i for x in self.fixed.values() for i in x], np.int32),
                       np.array([len(x) for x in self.fixed.values()], np.int64))

    def _take(self, chunks: list[str]) -> None:
        """Add chunks that the newer generation lacks, from the older one or anew."""
        at = np.fromiter(map(self.older.index.get, chunks, repeat(-1)), np.int64, len(chunks))
        if (at >= 0).any():
            self.newer.add([chunks[i] for i in np.flatnonzero(at >= 0).tolist()], *self.older.ids_at(at[at >= 0]))
            chunks = [chunks[i] for i in np.flatnonzero(at < 0).tolist()]
        if chunks:
            self.newer.add(chunks, *self.learn(chunks))

    def __call__(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all lists in order, and the number of ids of each list."""
        if len(self.newer.index) > self.limit // 2:
            self.older = self.newer
            self._begin()
        coded = pa.array(list(chain.from_iterable(lists)), pa.large_string()).dictionary_encode()
        chunks = coded.dictionary.to_pylist()     # few of many: Arrow finds the distinct ones
        known = np.fromiter(map(self.newer.index.get, chunks, repeat(-1)), np.int64, len(chunks))
        gaps = np.flatnonzero(known < 0)
        if len(gaps):
            lost = [chunks[i] for i in gaps.tolist()]
            self._take(lost)
            known[gaps] = np.fromiter(map(self.newer.index.__getitem__, lost), np.int64, len(lost))
        at = known[coded.indices.to_numpy()]
        ids, lens = self.newer.ids_at(at)
        stop = np.cumsum(lens)
        cuts = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
        return ids, np.diff(np.concatenate([[0], stop])[np.concatenate([[0], cuts])])


def split_at(ids: np.ndarray, mark: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and lengths of n chunks that were encoded as one text with ``mark`` after each."""
    ends = np.flatnonzero(ids == mark)
    if len(ends) != n:
        raise ValueError("the separator is not an id of its own")
    return ids[ids != mark], np.diff(np.concatenate([[-1], ends])) - 1
