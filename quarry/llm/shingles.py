"""Sets of word shingles of many texts at once, by whole-array operations on their bytes."""

from __future__ import annotations

import numpy as np

from quarry.llm.common import BLOCK_BYTES, byte_codes, joined, mix64

N = 5
ID_BITS = 54   # a shingle's id; the bits above number the text within a block of at most 1,000

_BASE = 0x9E3779B97F4A7C15
_CODES = byte_codes(7)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32   # A-Z only

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, up to at least n."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def word_hashes(texts: list[bytes], fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word in order, and the number of words of each text.

    Words are runs of bytes outside 0x20 and 0x09-0x0D; with ``fold``, A-Z
    count as a-z. The hash is a polynomial over random byte codes, taken from
    prefix sums at the word's bounds.
    """
    raw, off = joined(texts)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    inside = ~_SPACE[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1   # a space ends the bytes
    if inside[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    words = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):   # a stretch of bounded length (or one longer word) at a time
        j = max(i + 1, int(np.searchsorted(end, start[i] + BLOCK_BYTES, "right")))
        part = raw[start[i]:end[j - 1]]
        power, inverse = _power_tables(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_CODES[_FOLD[part] if fold else part] * power[:len(part)], out=sums[1:])
        s, e = start[i:j] - start[i], end[i:j] - start[i]
        words[i:j] = mix64((sums[e] - sums[s]) * inverse[s])
        i = j
    return words, np.diff(np.searchsorted(start, off))


def shingle_sets(texts: list[bytes], n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle ids of every text, sorted by text and id, and their number per text.

    A text with fewer than n words has its whole word sequence as its only
    shingle; one without words has none. At most 1,000 texts.
    """
    words, counts = word_hashes(texts)
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    first = np.cumsum(counts) - counts
    keys = []
    if len(words) >= n:
        h = words[:len(words) - n + 1]
        for i in range(1, n):
            h = mix64(h + words[i:len(words) - n + 1 + i] * np.uint64(2 * i + 1))
        whole = doc[n - 1:] == doc[:len(doc) - n + 1]
        keys.append(doc[:len(h)][whole] << np.uint64(ID_BITS) | h[whole] >> np.uint64(64 - ID_BITS))
    for size in range(1, n):
        at = np.flatnonzero(counts == size)
        if len(at):
            h = words[first[at]] + np.uint64(size)
            for i in range(1, size):
                h = mix64(h + words[first[at] + i] * np.uint64(2 * i + 1))
            keys.append(at.astype(np.uint64) << np.uint64(ID_BITS) | mix64(h) >> np.uint64(64 - ID_BITS))
    key = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    sizes = np.bincount((key >> np.uint64(ID_BITS)).astype(np.int64), minlength=len(texts))
    return key & np.uint64((1 << ID_BITS) - 1), sizes
