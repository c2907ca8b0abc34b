"""Packing tokenized documents into fixed windows, keeping their order.

The ids of consecutive documents form one stream. Windows of at most ``size``
ids are cut from it by dynamic programming over the stream's boundaries: ends
of documents (free), ends of sentences (small penalty) and, inside longer
stretches without either, fixed steps (large penalty). With f[j] the least
cost of the stream up to boundary j,

    f[j] = penalty[j] + size - pos[j] + min(f[i] + pos[i] : pos[j] - pos[i] <= size)

so the inner minimum slides over the boundaries and a monotone queue gives it
in amortized constant time. What is left at the end of a stream is cut into
lengths that are powers of two, which need no padding.
"""

from __future__ import annotations

import json
import os
import re
import sys
from collections import deque
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import row_blocks, texts_of, tidied
from quarry.llm.idtable import IdTable
from quarry.llm.token_counts import PairRanks, merge_symbols

SIZE = 4096
END_ID = 2
SENTENCE_PENALTY = 8     # in ids of padding: a cut between sentences of one document
HARD_PENALTY = 48        # a cut inside a sentence
HARD_STEP = 64           # distance of the cuts offered inside a long stretch
STREAM_BYTES = 2 << 20   # text packed as one stream inside a task
LOW = 0x180             # texts of characters below (Latin) are cut into units here, others word by word by the library
NONE = np.zeros(0, np.int32), np.zeros(0, np.int64)
JOIN = 5_000            # distinct units merged at once
LONG = 100              # letters; the library encodes longer runs
UNIT_BYTES = 1 << 20    # text held as units at once
UNITS = 120_000         # distinct units kept per task

PIECES = ("doc_id bigint, start bigint, length bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, ids binary")


def _unit_pattern() -> re.Pattern:
    """The tokenizer's own cut of lower-cased text, its classes written out for characters below ``LOW``.

    Fixed value: contractions, runs of letters, single numbers, runs of other signs; white space is dropped.
    """
    letter, number, space = ("".join(re.escape(chr(c)) for c in range(LOW) if regex.match(name, chr(c))) for name in (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{space}{letter}{number}]+")


class WordEncoder:
    """Ids of texts whose tokenizer never joins ids across white space.

    A text is cut into units as the tokenizer cuts it, and distinct units are
    encoded once: runs of letters by the tokenizer's merges, all at once, the
    few others by the whole library. A word with characters from ``LOW`` on is one
    unit for the library. Texts with a special token's opening (which the
    library looks for first) are encoded whole.
    """

    def __init__(self, tokenizer_json: bytes, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_buffer(tokenizer_json)
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.special = {t[:2] for t in added}
        model = json.loads(tokenizer_json)["model"]
        self.ranks = PairRanks(model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]])
        sign = {i: piece for piece, i in model["vocab"].items()}
        self.last = np.array([model["vocab"][sign[i] + (model["end_of_word_suffix"] or "")] for i in self.ranks.byte.tolist()], np.int64)
        self.sentence_end = np.zeros(self.tok.get_vocab_size() + 1, bool)
        for piece, i in self.tok.get_vocab().items():
            word = piece.removesuffix("</w>")
            if piece.endswith("</w>") and word and set(word) <= set(".!?") and i < len(self.sentence_end):
                self.sentence_end[i] = True
        self.find = _unit_pattern().findall
        self.high = re.compile(f"[{chr(LOW)}-{chr(sys.maxunicode)}]").search
        self.table = IdTable(self._learn, {"": [], "\n": [end_id]}, UNITS)

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, by the merges over their bytes."""
        parts = [NONE]
        for k in range(0, len(words), JOIN):
            ids, lens = merge_symbols([w.encode() for w in words[k:k + JOIN]], self.ranks, self.last)
            parts.append((ids.astype(np.int32), lens))
        return np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts])

    def _whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of each word."""
        ids = [e.ids for e in self.tok.encode_batch_fast(words, add_special_tokens=False)] if words else []
        return np.array([i for x in ids for i in x], np.int32), np.array([len(x) for x in ids], np.int64)

    def _learn(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.fromiter((u.isalpha() and len(u) <= LONG and (u.isascii() or self.high(u) is None) for u in units), bool, len(units))
        order = np.argsort(~plain, kind="stable")
        n = int(plain.sum())
        ids, lens = (np.concatenate(x) for x in zip(self._letters([units[i] for i in order[:n].tolist()]),
                                                    self._whole([units[i] for i in order[n:].tolist()]), strict=True))
        back = np.argsort(order)
        own = lens[back]
        stop = np.cumsum(own)
        first = (np.cumsum(lens) - lens)[back]
        return ids[np.arange(len(ids)) + np.repeat(first - (stop - own), own)], own

    def _low_units(self, text: str) -> list[str] | None:
        if text.isascii() or self.high(text) is None and is_normalized("NFC", text):
            return self.find(text.lower())
        return None

    def _units(self, text: str) -> list[str]:
        if any(s in text for s in self.special):
            return [text if text != "\n" else "", "\n"]
        units = self._low_units(text)
        if units is None:
            units = []
            for word in text.replace("\n", " ").split(" "):
                low = self._low_units(word)
                units += [word] if low is None else low
        units.append("\n")   # stands for the end id
        return units

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text (end id included)."""
        parts = [self.table([self._units(t.decode()) for t in texts[part]]) for part in row_blocks(texts, UNIT_BYTES)]
        return tuple(np.concatenate(x) for x in zip(NONE, *parts, strict=True))


def boundaries(total: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, step: int = HARD_STEP) -> tuple[np.ndarray, np.ndarray]:
    """Positions where the stream may be cut, from 0 to its end, and their penalties."""
    kind = np.zeros(total + 1, np.uint8)   # 0 none, 1 hard, 2 sentence, 3 document
    kind[sentence_ends] = 2
    kind[doc_ends] = 3
    kind[[0, total]] = 3
    pos = np.flatnonzero(kind)
    gaps = np.diff(pos)
    wide = np.flatnonzero(gaps > step)
    if len(wide):
        n = (gaps[wide] - 1) // step
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + 1
        kind[np.repeat(pos[wide], n) + k * step] = 1
        pos = np.flatnonzero(kind)
    return pos, np.array([0, HARD_PENALTY, SENTENCE_PENALTY, 0])[kind[pos]]


def cut(pos: np.ndarray, penalty: np.ndarray, size: int = SIZE) -> list[int]:
    """Ends of the windows of least padding plus penalties, by a monotone queue.

    The last window's padding does not count.

    Neighbouring boundaries must be at most ``size`` apart.
    """
    where, cost = pos.tolist(), penalty.tolist()
    n = len(where)
    back = [0] * n
    key = [0] * n            # f[i] + pos[i]
    queue: deque[int] = deque([0])
    for j in range(1, n):
        p = where[j]
        while where[queue[0]] < p - size:
            queue.popleft()
        i = queue[0]
        back[j] = i
        key[j] = k = key[i] + size + cost[j]   # f[j] + pos[j]
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    # the last window is free: what it leaves is cut into lengths without padding
    j = n - 1
    tail = [i for i in range(j - 1, -1, -1) if where[i] >= where[j] - size] if j else []   # ends of one window
    if tail:
        back[j] = min(tail, key=lambda i: key[i] - where[i])
    ends = []
    while j > 0:
        ends.append(where[j])
        j = back[j]
    return ends[::-1]


def windows(ids_total: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Window bounds of a stream: 0, the cuts, and the end.

    The last window is cut further into powers of two.
    """
    if not ids_total:
        return np.zeros(1, np.int64)
    ends = cut(*boundaries(ids_total, doc_ends, sentence_ends), size)
    start = ends[-2] if len(ends) > 1 else 0
    rest, tail = ids_total - start, []
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            start += 1 << bit
            tail.append(start)
    return np.array([0, *ends[:-1], *tail], np.int64)


def streams(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[pa.Array, list[bytes]]]:
    ids, texts = batch.column("id"), texts_of(batch, "text")
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit or i + 1 == len(texts):
            yield ids.slice(start, i + 1 - start), texts[start:i + 1]
            start, size = i + 1, 0


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         size: int = SIZE, end_id: int = END_ID, stream_bytes: int = STREAM_BYTES) -> DataFrame:
    """Pieces of documents in sequences of at most ``size`` ids.

    One row per piece (``PIECES``): the document's id, the ids before the
    piece in its document, the piece's length and ids (little-endian unsigned
    32-bit), the document's ids in all, the sequence and the offset there.
    A document is its text's ids and then ``end_id``; null and empty texts are
    the end id alone. Rows are packed in the order of the scan, each task on
    its own streams, so no row moves; sequences are numbered by partition and
    place. Repeated rows are packed each; a null id stays null. ``size`` must
    be a power of two not below ``HARD_STEP``.
    """
    if size < HARD_STEP or size & (size - 1):
        raise ValueError("size must be a power of two of at least HARD_STEP")
    with open(tokenizer_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())   # one vocabulary file, a few MB
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        from pyspark import TaskContext
        encode = WordEncoder(model.value, end_id)
        sequence = TaskContext.get().partitionId() << 36
        for b in batches:
            for doc_ids, texts in streams(b, stream_bytes):
                ids, lens = encode(texts)
                ends = np.cumsum(lens)
                stops = np.flatnonzero(encode.sentence_end[np.minimum(ids, len(encode.sentence_end) - 1)]) + 1
                wins = windows(len(ids), ends, stops, size)
                cuts = np.union1d(wins, np.concatenate([[0], ends]))
                first, last = cuts[:-1], cuts[1:]
                doc = np.searchsorted(ends, first, "right")
                win = np.searchsorted(wins, first, "right") - 1
                raw = ids.astype("<u4").tobytes()
                cols = [doc_ids.take(pa.array(doc)), pa.array(first - (ends - lens)[doc]), pa.array(last - first),
                        pa.array(lens[doc]), pa.array(sequence + win), pa.array(first - wins[win]),
                        pa.array([raw[4 * s:4 * e] for s, e in zip(first.tolist(), last.tolist(), strict=True)], pa.binary())]
                sequence += len(wins) - 1
                yield pa.RecordBatch.from_arrays(
                    cols, ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return src.mapInArrow(tidied(run), PIECES)
