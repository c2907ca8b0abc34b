"""Sentences and n-gram frequencies of a text corpus.

Plan: one scan, narrow explodes (paragraph -> sentence), one shuffle of packed
pieces of sentences that are counted in blocks before and after it, and a
per-n top-k that ranks only the n-grams at or above the k-th largest count of
their n.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain, islice, product

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T

SEPARATORS = T.NGRAM_SPLIT_REGEX.replace("]", " ]")   # all but the blank, which separates already
SHORT = 2                # n-grams up to this length are pieces of their own, longer ones are prefixes of windows
BUCKETS = 4096           # pieces are dealt out by these; a task counts several small buckets at once
BLOCK_BYTES = 8 << 20    # of text, counted at once inside a task
BATCH = 1 << 20          # pieces or n-grams that leave a task at once
BLANK, NEWLINE = 32, 10  # end a word, and the last word of a line
COMMON_WORDS = 1 << 16   # spelled short in the shuffle
COMMON_LINES = 50_000    # in which these are looked up
DENSE_BYTES = 96 << 20   # of pieces and counts, compressed together bucket by bucket
PIECES = ["bucket", "least", "pieces", "counts"]
DENSE = "bucket int, least int, n_bytes int, n_pieces int, dense binary"


def split_sentences(paras: DataFrame, para_col: str = "paragraph") -> DataFrame:
    """One row per sentence (pieces between literal ". "), with its index."""
    keep = [c for c in paras.columns if c != para_col]
    return paras.select(*keep, F.posexplode(T.sentences(F.col(para_col))).alias("sent_idx", "sentence"))


def normalize_sentences(sents: DataFrame, col: str = "sentence") -> DataFrame:
    return sents.withColumn(col, T.normalize_sentence(F.col(col)))


def explode_ngrams(sents: DataFrame, ns=(1, 2, 3, 4, 5), col: str = "sentence") -> DataFrame:
    """``(n, ngram)`` rows for every n in ``ns``; never across sentences.

    Each word position starts one n-gram per n that fits in the sentence.
    The longest one is joined once per position; the shorter ones are its
    prefixes up to the n-th blank (words never contain blanks, so this is
    exact even with empty words). Only generators and string functions with
    generated code are used (no per-element lambdas).
    """
    words = sents.select(T.ngram_words(F.col(col)).alias("words"))
    starts = words.select("words", F.posexplode("words").alias("pos", "w"))
    longest = starts.select("words", "pos",
                            F.array_join(F.slice("words", F.col("pos") + 1, max(ns)), " ").alias("g"))
    with_n = longest.select("words", "pos", "g", F.explode(F.array(*[F.lit(n) for n in ns])).alias("n"))
    fits = with_n.where(F.col("pos") + F.col("n") <= F.size("words"))
    return fits.select("n", F.expr("substring_index(g, ' ', n)").alias("ngram"))


def ngram_counts(sents: DataFrame, ns=(1, 2, 3, 4, 5), col: str = "sentence") -> DataFrame:
    """``(n, ngram, cnt)``: occurrences of every n-gram.

    A task counts the distinct pieces of each block of sentences: words, word
    pairs, and per position a window of ``max(ns)`` words (at the end of a
    sentence the words that are left). Pieces are shuffled packed, by their
    first words, three in a window, so that all copies of an n-gram meet:
    one window stands for all n-grams above ``SHORT`` that begin where it
    does. They are counted as its prefixes, again in blocks, so memory is
    bounded by a bucket and not by the input; a frequent n-gram comes at most
    once (as a window's prefix, once per distinct window) from each block.
    On the way common words are spelled short, and the pieces of some blocks
    are compressed together; both only make the shuffle smaller.
    """
    ns = tuple(sorted(set(ns)))
    lines = (sents.where(F.col(col).isNotNull())
             .select(F.concat(F.regexp_replace(F.col(col), SEPARATORS, " "), F.lit("\n")).alias("line")))
    common = sents.sparkSession.sparkContext.broadcast(_common_words([r.line for r in lines.take(COMMON_LINES)]))
    pieces = lines.mapInArrow(lambda batches: _dense(_block_pieces(batches, ns, common.value)), DENSE)
    dealt = pieces.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda batches: _bucket_counts(_loose(batches), ns, common.value), "n int, ngram string, cnt bigint")


class _Words:
    """The words of a text whose words end with one blank, or with a newline after the last one of a line."""

    def __init__(self, text: np.ndarray):
        self.text, self.hash = text, None
        self.end = np.flatnonzero(text <= BLANK)
        self.start = np.concatenate([[0], self.end[:-1] + 1])
        offsets = np.zeros(len(self.end) + 1, np.int64)
        np.cumsum(self.end - self.start, out=offsets[1:])
        words = pa.LargeStringArray.from_buffers(len(self.end), pa.py_buffer(offsets), pa.py_buffer(text[text > BLANK]))
        coded = words.dictionary_encode()
        self.vocabulary, self.code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        last = np.flatnonzero(text[self.end] == NEWLINE)
        in_line = np.diff(last, prepend=-1)
        self.first = last - in_line + 1                     # of each line
        self.left = np.repeat(last + 1, in_line) - np.arange(len(self.end))   # words up to the line's end

    def ngrams(self, at: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For n = 1 .. longest: n, the positions in ``at`` with n words, their n-gram's code, a position of each code."""
        code = self.code[at]
        for n in range(1, longest + 1):
            if n > 1:
                fits = self.left[at] >= n
                at = at[fits]
                code = code[fits] * len(self.vocabulary) + self.code[at + n - 1]
            code, distinct = pd.factorize(code)
            shown = np.empty(len(distinct), np.int64)
            shown[code] = at
            yield n, at, code, shown

    def buckets(self, at: np.ndarray, n: int) -> np.ndarray:
        """The bucket of the n words at each position, the same in every block."""
        if self.hash is None:
            self.hash = pd.util.hash_array(self.vocabulary.to_numpy(zero_copy_only=False), categorize=False)
        out = np.zeros(len(at), np.uint64)
        for k in range(n):
            out = (out + self.hash[self.code[at + k]]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        return (out % np.uint64(BUCKETS)).astype(np.uint16)

    def respell(self, old: pa.Array, new: pa.Array) -> None:
        """Spell words in ``text`` anew; their codes and hashes stay those of the words as they were."""
        words = _respelled(self.vocabulary, old, new).take(pa.array(self.code))
        offsets = np.frombuffer(words.buffers()[1], np.int64)[:len(words) + 1]
        end = offsets[1:] + np.arange(len(words))
        text = np.empty(offsets[-1] + len(words), np.uint8)
        letter = np.ones(len(text), bool)
        letter[end] = False
        text[letter], text[end] = np.frombuffer(words.buffers()[2], np.uint8)[:offsets[-1]], self.text[self.end]
        self.text, self.end, self.start = text, end, np.concatenate([[0], end[:-1] + 1])

    def lines(self, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The n words at each position as lines of one text, and where each line begins in it."""
        start, last = self.start[at], self.end[at + n - 1]
        stop = np.cumsum(last + 1 - start)
        byte = np.ones(stop[-1], np.int64)      # steps from byte to byte, then their sums
        byte[0], byte[stop[:-1]] = start[0], start[1:] - last[:-1]
        out = self.text.take(np.cumsum(byte, out=byte))
        out[stop - 1] = NEWLINE
        return out, np.append(0, stop[:-1])


def _common_words(lines: list[str]) -> tuple[pa.Array, pa.Array]:
    """The most frequent words of the lines and a shorter spelling of each, which no word has as words are of 0-9 and a-z only.

    It only tells how words are written in the shuffle: one that is missing here is written as it is.
    """
    if not lines:
        return pa.array([], pa.large_string()), pa.array([], pa.large_string())
    words = _Words(np.frombuffer("".join(lines).encode(), np.uint8))
    ranked = np.argsort(-np.bincount(words.code), kind="stable")[:COMMON_WORDS]
    marks = [chr(c) for c in range(BLANK + 1, 127)]
    first = [c for c in marks if not (c.isdigit() or c.islower())]
    spellings = ("".join(x) for x in chain(first, product(first, marks), product(first, marks, marks)))
    old, new, short = [], [], next(spellings)
    for w in words.vocabulary.take(pa.array(ranked)).to_pylist():
        if len(w) > len(short):
            old.append(w)
            new.append(short)
            short = next(spellings)
    return pa.array(old, pa.large_string()), pa.array(new, pa.large_string())


def _respelled(words: pa.Array, old: pa.Array, new: pa.Array) -> pa.Array:
    """The words, those in ``old`` replaced by the ones at their place in ``new``."""
    return pc.coalesce(new.take(pc.index_in(words, value_set=old)), words)


def _blocks(batches: Iterable[pa.RecordBatch], columns: int) -> Iterator[pa.Table]:
    """Consecutive rows of about ``BLOCK_BYTES``; with ``columns`` > 1 rows of equal first column stay together."""
    held, size = [], 0
    for b in batches:
        step = max(1, b.num_rows * BLOCK_BYTES // max(b.nbytes, 1))
        for k in range(0, b.num_rows, step):
            part = b.slice(k, step)
            if size >= BLOCK_BYTES:
                cut = 0
                if columns > 1:     # up to the end of the bucket that was begun
                    cut = int(np.searchsorted(part.column(0).to_numpy(), held[-1].column(0)[-1].as_py(), "right"))
                if cut < part.num_rows:
                    yield pa.Table.from_batches([*held, part.slice(0, cut)])
                    held, size, part = [], 0, part.slice(cut)
            held.append(part)
            size += part.nbytes
    if held:
        yield pa.Table.from_batches(held)


def _bytes_of(column: pa.ChunkedArray, kind: type = np.uint8) -> np.ndarray:
    """The values of a string or binary column, end to end."""
    out = []
    for c in column.chunks:
        if len(c):
            offsets = np.frombuffer(c.buffers()[1], np.int32)[c.offset:c.offset + len(c) + 1]
            out.append(np.frombuffer(c.buffers()[2], np.uint8)[offsets[0]:offsets[-1]])
    return np.concatenate(out).view(kind) if out else np.empty(0, kind)


def _packed(values: np.ndarray, begins: np.ndarray) -> pa.Array:
    """The bytes of ``values`` as binaries that begin at the given values."""
    offsets = np.append(begins, len(values)).astype(np.int32) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _block_pieces(batches: Iterable[pa.RecordBatch], ns: tuple[int, ...],
                  common: tuple[pa.Array, pa.Array] | None = None) -> Iterator[pa.RecordBatch]:
    """Per block, length and bucket the distinct pieces and how often each occurs in the block."""
    for block in _blocks(batches, 1):
        words = _Words(_bytes_of(block.column(0)))
        if common:
            words.respell(*common)
        for n, at, code, shown in words.ngrams(np.arange(len(words.code)), ns[-1]):
            if n <= SHORT:
                if n not in ns:
                    continue
            elif n < ns[-1]:        # a window that the end of its sentence cuts here
                code = code[words.left[at] == n]
            counts = np.bincount(code, minlength=len(shown))
            seen = np.flatnonzero(counts)
            least = min(n, SHORT + 1)
            bucket = words.buckets(shown[seen], least)
            order = np.argsort(bucket, kind="stable")
            for some in range(0, len(order), BATCH):
                part = order[some:some + BATCH]
                own = bucket[part].astype(np.int32)
                begins = np.flatnonzero(np.diff(own, prepend=-1))
                text, line = words.lines(shown[seen[part]], n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[begins]), pa.array(np.full(len(begins), least, np.int32)),
                     _packed(text, line[begins]), _packed(counts[seen[part]], begins)], PIECES)


def _dense(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces and counts that some blocks have for a bucket, compressed as one row."""
    zstd, held, size = pa.Codec("zstd"), [], 0
    for b in chain(batches, [None]):
        if held and (b is None or size + b.nbytes > DENSE_BYTES):
            yield from _compressed(zstd, pa.Table.from_batches(held))
            held, size = [], 0
        if b is not None:
            held.append(b)
            size += b.nbytes


def _compressed(zstd: pa.Codec, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    bucket, least = rows["bucket"].to_numpy(), rows["least"].to_numpy()
    order = np.lexsort((bucket, least))
    begins = np.flatnonzero(np.diff(bucket[order], prepend=-1) | np.diff(least[order], prepend=-1))
    pieces, counts = ([x for c in rows[name].chunks for x in c] for name in ("pieces", "counts"))
    for some in range(0, len(begins), 1024):
        out = []
        for begin, end in zip(begins[some:some + 1024], np.append(begins[some + 1:some + 1025], len(order))):
            own = order[begin:end]
            text = b"".join(pieces[k].as_buffer() for k in own)
            count = np.frombuffer(b"".join(counts[k].as_buffer() for k in own), np.uint8)
            dense = zstd.compress(text + count.reshape(-1, 8).T.tobytes(), asbytes=True)   # like bytes of the counts side by side
            out.append((bucket[own[0]], least[own[0]], len(text), len(count) // 8, dense))
        yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int32()) for x in list(zip(*out))[:4]), pa.array([x[4] for x in out], pa.binary())],
                                         [x.split()[0] for x in DENSE.split(", ")])


def _loose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that ``_dense`` has compressed, a block's bytes at a time."""
    zstd = pa.Codec("zstd")
    for b in batches:
        n_bytes, n_pieces = b.column(2).to_numpy().astype(np.int64), b.column(3).to_numpy().astype(np.int64)
        part = np.cumsum(n_bytes + 8 * n_pieces) // BLOCK_BYTES
        begins = np.flatnonzero(np.diff(part, prepend=-1))
        for begin, end in zip(begins, np.append(begins[1:], b.num_rows)):
            pieces, counts = [], []
            for k in range(begin, end):
                raw = zstd.decompress(b.column(4)[k].as_buffer(), int(n_bytes[k] + 8 * n_pieces[k]))
                pieces.append(raw[:n_bytes[k]].to_pybytes())
                counts.append(np.frombuffer(raw, np.uint8)[n_bytes[k]:].reshape(8, -1).T.tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0).slice(begin, end - begin), b.column(1).slice(begin, end - begin),
                                              pa.array(pieces, pa.binary()), pa.array(counts, pa.binary())], PIECES)


def _bucket_counts(batches: Iterable[pa.RecordBatch], ns: tuple[int, ...],
                   common: tuple[pa.Array, pa.Array] | None = None) -> Iterator[pa.RecordBatch]:
    """The counts of all n-grams of whole buckets; pieces of ``least`` words or more give their n-grams from ``least`` on."""
    for block in _blocks(batches, 4):
        for least in range(1, SHORT + 2):
            rows = block.filter(pc.equal(block["least"], least))
            if not rows.num_rows:
                continue
            words = _Words(_bytes_of(rows["pieces"]))
            if common:
                words.vocabulary = _respelled(words.vocabulary, *common[::-1])
            weight = np.zeros(len(words.code))
            weight[words.first] = _bytes_of(rows["counts"], np.int64)
            for n, at, code, shown in words.ngrams(words.first, ns[-1] if least > SHORT else least):
                if n < least or n not in ns:
                    continue
                counts = np.bincount(code, weight[at], len(shown)).astype(np.int64)   # whole numbers below 2 ** 53: exact
                for some in range(0, len(shown), BATCH):
                    at = shown[some:some + BATCH]
                    parts = [words.vocabulary.take(pa.array(words.code[at + k])) for k in range(n)]
                    grams = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), n, np.int32)), grams,
                                                      pa.array(counts[some:some + BATCH])], ["n", "ngram", "cnt"])


def top_ngrams(counts: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent n-grams for each n; ties by n-gram ascending.

    Exact, without sorting every distinct n-gram: the histogram of counts per
    n (one row per distinct count value) gives the k-th largest count of each
    n; only n-grams at or above it (ties included) are ranked. The threshold
    table has one row per n, so broadcasting it is bounded by the parameters.
    """
    hist = counts.groupBy("n", "cnt").agg(F.count(F.lit(1)).alias("m"))
    running = Window.partitionBy("n").orderBy(F.col("cnt").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    thr = (hist.withColumn("at_least", F.sum("m").over(running))
           .where(F.col("at_least") >= k).groupBy("n").agg(F.max("cnt").alias("thr")))
    # an n with fewer than k distinct n-grams has no threshold and keeps all
    cand = (counts.join(F.broadcast(thr), "n", "left")
            .where(F.col("thr").isNull() | (F.col("cnt") >= F.col("thr"))).drop("thr"))
    w = Window.partitionBy("n").orderBy(F.col("cnt").desc(), F.col("ngram").asc())
    return (cand.withColumn("rnk", F.row_number().over(w))
            .where(F.col("rnk") <= k)
            .select("n", "rnk", "ngram", "cnt"))


def corpus_sentences(docs: DataFrame, text_col: str = "text", key_col: str = "doc_id") -> DataFrame:
    """Normalised sentences of a text table: paragraph split, sentence split, normalise."""
    paras = docs.select(key_col, F.posexplode(T.paragraphs(F.col(text_col))).alias("para_idx", "paragraph"))
    return normalize_sentences(split_sentences(paras))
