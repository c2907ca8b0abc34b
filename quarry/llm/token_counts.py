"""Token counts of texts under a byte-level BPE vocabulary, by rank-synchronous array merging.

A text is cut into pre-tokens, no merge crosses them. The distinct pre-tokens
of a block that a task has not counted yet are held as one ragged array of
symbols. In each round every sequence applies its lowest-ranked pair at all of
its places at once; sequences without a ranked pair leave the array, and the
symbols that they have left are their token counts. Ids are never listed.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import row_blocks, texts_of, tidied

LIMIT = 200_000        # distinct pre-tokens that a task remembers; the older half goes first
LONG = 256             # symbols; longer sequences are merged one by one
SEGMENT = 1 << 20      # characters of a text cut into pre-tokens at once
NEVER = np.iinfo(np.int32).max
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
#: Fixed value: how byte-level vocabularies cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
FAST_TOP = 0x2C00      # texts below this code point are cut by the standard module, which is faster


@functools.cache
def fast_pattern() -> re.Pattern:
    """``PATTERN`` with its classes written out for characters below ``FAST_TOP``."""
    def members(name):
        inside = regex.compile(name).match
        return "".join(re.escape(chr(c)) for c in range(FAST_TOP) if inside(chr(c)))
    letter, number, space = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
                      f"|[{space}]+(?![^{space}])|[{space}]+")


@functools.cache
def unsettled() -> frozenset[str]:
    """Characters whose class depends on the Unicode version: only newer tables call them letters or numbers."""
    own = regex.compile(r"[\p{L}\p{N}\s]").match
    return frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn" and own(c))


@functools.cache
def unsettled_low() -> re.Pattern:
    low = "".join(sorted(c for c in unsettled() if ord(c) < FAST_TOP))
    return re.compile(f"[{low}]" if low else "(?!)")


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """Parts of a long text, cut in front of a space behind another sign: no pre-token crosses such a place."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.end()]
        start = cut.end()
    yield text[start:]


_CUT = re.compile(r"\S(?= )")


class PairRanks:
    """The ranks of a vocabulary's merges, looked up for arrays of symbol pairs.

    Every merge must make a symbol of its own, behind the merges that made its
    parts. Then a pair that a merge creates ranks behind it, and taking the
    lowest pair at all its places at once is the order of the library.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.size = max(vocab.values()) + 1
        shown = (*range(33, 127), *range(161, 173), *range(174, 256))   # bytes shown as their own sign
        rest = iter(range(256, 512))
        self.byte = np.array([vocab[chr(b if b in shown else next(rest))] for b in range(256)], np.int64)
        left, right = (np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
        made = np.array([vocab["".join(m)] for m in merges], np.int64)
        born = np.full(self.size, -1, np.int64)
        born[made] = np.arange(len(made))
        rank = np.arange(len(made))
        if (born[made] != rank).any() or (np.maximum(born[left], born[right]) >= rank).any() or (born[self.byte] >= 0).any():
            raise ValueError("merges must each make a symbol of their own, behind its parts")
        order = np.argsort(left * self.size + right)
        self.key, self.rank, self.made = (left * self.size + right)[order], order.astype(np.int32), made
        self.parts = left, right
        # most pairs are found by their slot; slots that several share send theirs to the sorted keys
        slot = self._slot(self.key)
        self.slot_key, self.slot_rank = np.full(SLOTS, -1, np.int64), np.full(SLOTS, NEVER, np.int32)
        self.slot_key[slot], self.slot_rank[slot] = self.key, self.rank
        self.crowded = np.bincount(slot, minlength=SLOTS) > 1

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NEVER`` where no merge joins it."""
        want = left * self.size + right
        slot = self._slot(want)
        out = np.where(self.slot_key[slot] == want, self.slot_rank[slot], NEVER).astype(np.int32)
        other = np.flatnonzero(self.crowded[slot] & (out == NEVER))
        if len(other):
            at = np.minimum(np.searchsorted(self.key, want[other]), len(self.key) - 1)
            out[other] = np.where(self.key[at] == want[other], self.rank[at], NEVER)
        return out


def every_other(hits: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Of ascending places whose pairs may overlap, the first, third, ... of each run of overlapping ones."""
    first = np.flatnonzero(~follows)
    run = np.arange(len(hits)) - np.repeat(first, np.diff(np.append(first, len(hits))))
    return hits[run % 2 == 0]


def merge_counts(chunks: list[bytes], ranks: PairRanks) -> np.ndarray:
    """The number of symbols that each byte string ends with."""
    lens = np.fromiter(map(len, chunks), np.int64, len(chunks))
    out = np.zeros(len(chunks), np.int64)
    for i in np.flatnonzero(lens > LONG).tolist():
        out[i] = merge_long(ranks.byte[np.frombuffer(chunks[i], np.uint8)], ranks)
    own = np.flatnonzero((lens > 0) & (lens <= LONG))
    sym = ranks.byte[np.frombuffer(b"".join([chunks[i] for i in own.tolist()]), np.uint8)]
    for seq, size, _ in merge_rounds(sym, lens[own], ranks):
        out[own[seq]] = size
    return out


def merge_symbols(chunks: list[bytes], ranks: PairRanks, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of short byte strings one after another, and their numbers; ``last`` has the symbols of last bytes."""
    lens = np.fromiter(map(len, chunks), np.int64, len(chunks))
    data = np.frombuffer(b"".join(chunks), np.uint8)
    sym = ranks.byte[data]
    ends = np.cumsum(lens) - 1
    sym[ends] = last[data[ends]]
    count = np.zeros(len(chunks), np.int64)
    seqs, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for seq, size, symbols in merge_rounds(sym, lens, ranks):
        count[seq] = size
        seqs.append(np.repeat(seq, size))
        found.append(symbols)
    return np.concatenate(found)[np.argsort(np.concatenate(seqs), kind="stable")], count


def merge_rounds(sym: np.ndarray, lens: np.ndarray, ranks: PairRanks) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Merge the ragged sequences (none empty), a round for all; yields (sequences, sizes, symbols) of those that are done."""
    seq = np.repeat(np.arange(len(lens)), lens)
    last = np.zeros(len(sym), bool)
    last[np.cumsum(lens) - 1] = True
    rank = np.full(len(sym), NEVER, np.int32)     # of the pair of a symbol and the next one of its sequence
    inner = np.flatnonzero(~last)
    rank[inner] = ranks(sym[inner], sym[inner + 1])
    while len(sym):
        stop = np.flatnonzero(last) + 1
        start = np.concatenate([[0], stop[:-1]])
        low = np.minimum.reduceat(rank, start)
        size = stop - start
        done = low == NEVER
        keep = np.repeat(~done, size)
        yield seq[start[done]], size[done], sym[~keep]
        hits = np.flatnonzero((rank == np.repeat(low, size)) & (rank != NEVER))
        hits = every_other(hits, np.concatenate([[False], (np.diff(hits) == 1) & (rank[hits[:-1]] == rank[hits[1:]])]))
        sym[hits] = ranks.made[rank[hits]]
        last[hits] = last[hits + 1]
        keep[hits + 1] = False
        place = np.cumsum(keep) - 1
        hits = place[hits]
        sym, seq, last, rank = sym[keep], seq[keep], last[keep], rank[keep]
        rank[hits[last[hits]]] = NEVER
        new = hits[~last[hits]]
        before = hits[hits > 0] - 1
        new = np.concatenate([new, before[~last[before]]])
        rank[new] = ranks(sym[new], sym[new + 1])


def merge_long(sym: np.ndarray, ranks: PairRanks) -> int:
    """The same for one long sequence: its places wait by rank, so a round costs what it merges."""
    n = len(sym)
    sym = np.append(sym, -1)
    nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
    alive = np.ones(n + 1, bool)
    waiting: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def put(at: np.ndarray):
        rank = ranks(sym[at], sym[nxt[at]])
        at, rank = at[rank != NEVER], rank[rank != NEVER]
        order = np.argsort(rank, kind="stable")
        edges = np.flatnonzero(np.diff(rank[order])) + 1
        for part in np.split(order, edges) if len(order) else ():
            r = int(rank[part[0]])
            if r not in waiting:
                heapq.heappush(heap, r)
            waiting.setdefault(r, []).append(at[part])

    put(np.arange(n - 1))
    while heap:
        r = heapq.heappop(heap)
        at = np.unique(np.concatenate(waiting.pop(r)))
        at = at[alive[at] & (nxt[at] < n)]
        at = at[(sym[at] == ranks.parts[0][r]) & (sym[nxt[at]] == ranks.parts[1][r])]
        if not len(at):
            continue
        at = every_other(at, np.concatenate([[False], nxt[at[:-1]] == at[1:]]))
        gone = nxt[at]
        sym[at] = ranks.made[r]
        alive[gone] = False
        nxt[at] = nxt[gone]
        prv[nxt[at]] = at
        near = np.concatenate([at, prv[at][prv[at] >= 0]])
        near = np.unique(near[nxt[near] < n])
        put(near[alive[near]])
    return int(alive[:n].sum())


class TokenCounter:
    """Numbers of tokens of whole texts; keeps a bounded table of counted pre-tokens."""

    def __init__(self, tokenizer_json: bytes, limit: int = LIMIT):
        spec = json.loads(tokenizer_json)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        added = spec["added_tokens"]
        if (model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
                or spec["normalizer"] or model.get("dropout") or model.get("end_of_word_suffix") or model.get("continuing_subword_prefix")
                or model.get("ignore_merges") or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)):
            raise ValueError("the vocabulary is not a plain byte-level BPE")
        self.ranks = PairRanks(model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]])
        names = sorted((t["content"] for t in added), key=lambda s: (-len(s), s))
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.any_text = regex.compile(PATTERN).findall
        self.limit = limit
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def _pre_tokens(self, text: str) -> list[str]:
        if text.isascii():
            return fast_pattern().findall(text)
        if not _HIGH.search(text):
            if not unsettled_low().search(text):
                return fast_pattern().findall(text)
        elif unsettled().isdisjoint(text):
            return self.any_text(text)
        from tokenizers import pre_tokenizers   # the library's own Unicode tables decide
        return [text[s:e] for _, (s, e) in pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]

    def _learn(self, chunks: list[str]) -> None:
        found = {c: k for c in chunks if (k := self.older.get(c))}
        new = [c for c in chunks if c not in found]
        self.known.update(found)
        self.known.update(zip(new, merge_counts([c.encode() for c in new], self.ranks).tolist(), strict=True))

    def _count(self, chunks: list[str]) -> np.ndarray:
        if len(self.known) > self.limit // 2:
            self.older, self.known = self.known, {}
        n = np.fromiter(map(self.known.get, chunks, repeat(0)), np.int64, len(chunks))
        gaps = np.flatnonzero(n == 0)
        if len(gaps):
            lost = [chunks[i] for i in gaps.tolist()]
            self._learn(list(dict.fromkeys(lost)))
            n[gaps] = np.fromiter(map(self.known.__getitem__, lost), np.int64, len(lost))
        return n

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        """The library's number of ids of each text, a special token's string in it as its one id."""
        out = np.zeros(len(texts), np.int64)
        chunks: list[str] = []
        cuts, rows, size = [0], [], 0

        def flush():
            nonlocal chunks, cuts, rows, size
            total = np.concatenate([[0], np.cumsum(self._count(chunks))])
            np.add.at(out, rows, np.diff(total[cuts]))
            chunks, cuts, rows, size = [], [0], [], 0

        for i, raw in enumerate(texts):
            text = raw.decode()
            parts = self.special.split(text) if self.special else [text]
            out[i] += len(parts) - 1
            for part in parts:
                for piece in segments(part):
                    chunks += self._pre_tokens(piece)
                    cuts.append(len(chunks))
                    rows.append(i)
                    size += len(piece)
                    if size > SEGMENT:
                        flush()
        flush()
        return out


_HIGH = re.compile(f"[{chr(FAST_TOP)}-{chr(sys.maxunicode)}]")


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """(id, ``n_bytes``, ``n_tokens``, ``over_limit``) for every input row; null text counts as empty.

    ``n_tokens`` is the number of ids that the library gives the whole text
    without added special tokens; ``over_limit`` is n_tokens > ``limit``.
    Empty text has 0 tokens, repeated rows are answered each, a null id stays
    null. Nothing is shuffled. Memory: an Arrow batch, the pre-tokens of about
    a MB of text and the bounded table; one text may be of any length.
    """
    with open(tokenizer_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())   # one vocabulary file, a few MB
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        count = TokenCounter(model.value)
        for b in batches:
            texts, ids = texts_of(b, "text"), b.column("id")
            for part in row_blocks(texts):
                n = count(texts[part])
                size = np.fromiter(map(len, texts[part]), np.int64, len(n))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(part.start, len(n)), pa.array(size), pa.array(n), pa.array(n > limit)],
                    ["id", "n_bytes", "n_tokens", "over_limit"])

    id_type = src.schema["id"].dataType.simpleString()
    return (src.mapInArrow(tidied(run), f"id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")
            .withColumnRenamed("id", id_col))
