"""Hard negatives by exact integer scores from a residue-number-system product.

Vectors are scaled to integers. Their components are reduced modulo a few
small primes, and the blocks of anchors and rows are multiplied modulo each
prime in float32, where every sum stays below 2^24 and is exact. The signed
scores come back by Chinese remaindering in mixed radix. The number of primes
follows from the longest vector of the table (no score exceeds its squared
length), so the scores are exact whatever the table holds.

The anchors are a stated query set. They are broadcast in chunks of a bounded
number of rows, each chunk against all rows twice: for the positives, then for
the negatives in the windows that the positives' scores open. A task keeps
only the best few of each anchor and window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import tidied

CHUNK = 16_384        # anchors broadcast at once
TILE = 2_048          # anchors multiplied at once
CELLS = 1 << 20       # scores held at once
EXACT = (1 << 24) - (1 << 10)   # float32 holds all integers up to here, and a multiple of a prime beside them
DEPTH = 1024          # components summed before a reduction
LARGEST = 1 << 59     # scores beyond cannot be compared in 64 bits
FOUND = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint, place bigint"


def primes_for(dim: int, bound: int) -> tuple[int, ...]:
    """Odd primes, the largest that ``dim`` components allow, whose product exceeds 4 * bound."""
    half = math.isqrt(EXACT // max(1, min(dim, DEPTH)))
    out, p = [], min(2 * half + 1, 4093)
    while math.prod(out) <= 4 * bound + 4 or len(out) < 2:
        if p < 3:
            raise ValueError("vectors are too long for exact products")
        if p % 2 and all(p % q for q in range(3, math.isqrt(p) + 1, 2)):
            out.append(p)
        p -= 1
    return tuple(out)


def reduced(x: np.ndarray, p: int) -> np.ndarray:
    """Numbers congruent to x modulo p, at most about p / 2 in size."""
    return x - p * np.rint(x * x.dtype.type(1 / p))


def residues(vectors: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """The matrices of components modulo each prime."""
    return [reduced(vectors, p).astype(np.float32) for p in primes]


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """Exact inner products of all rows of a with all rows of b, below prod(primes) / 4 in size.

    Float32 where the product of the primes allows it, else float64 or int64.
    """
    digits: list[np.ndarray] = []    # mixed radix: x = d0 + p0 * (d1 + p1 * (d2 + ...))
    for k, p in enumerate(primes):
        c = None
        for s in range(0, max(1, a[k].shape[1]), DEPTH):
            part = reduced(a[k][:, s:s + DEPTH] @ b[k][:, s:s + DEPTH].T, p)
            c = part if c is None else reduced(c + part, p)
        for d, q in zip(digits, primes, strict=False):
            inverse = pow(q, -1, p)
            c = reduced(reduced(c - d, p) * np.float32(inverse if 2 * inverse < p else inverse - p), p)
        digits.append(c)
    total = math.prod(primes)
    kind = np.float32 if total < 1 << 23 else np.float64 if total < 1 << 52 else np.int64
    x = digits[-1].astype(kind)
    for d, q in zip(digits[-2::-1], primes[-2::-1], strict=True):
        x = x * kind(q) + d.astype(kind)
    return x


def first_of_each(key: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each key: higher scores first, ties by smaller id."""
    order = np.lexsort((ident, -score, key))
    own = key[order]
    start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(start, np.diff(np.append(start, len(own))))
    return order[rank < k]


class Best:
    """The first k (score, id) of each of n keys so far, and the least score that still counts."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.limit = 2 * n * k + 10_000
        self.key, self.score, self.ident = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, key: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        self.pending.append((key, score, ident))
        self.size += len(key)
        if self.size > self.limit:
            self.settle()

    def settle(self) -> None:
        key, score, ident = (np.concatenate(x) for x in zip((self.key, self.score, self.ident), *self.pending, strict=True))
        kept = first_of_each(key, score, ident, self.k)
        self.key, self.score, self.ident = key[kept], score[kept], ident[kept]
        self.pending, self.size = [], 0
        last = np.flatnonzero(np.diff(self.key, append=-1))      # the last kept of each key
        last = last[last >= self.k - 1]
        full = last[self.key[last - self.k + 1] == self.key[last]]
        self.least[self.key[full]] = self.score[full]


def parsed(batch: pa.RecordBatch, scale: int, dim: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels, anchor flags and integer vectors (as doubles, padded with zeros) of the rows that take part."""
    column = batch.column("vec")
    lens = pc.fill_null(column.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    stop = np.cumsum(lens)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])   # null components came as NaN
    good = (bad[stop] - bad[stop - lens] == 0) & column.is_valid().to_numpy(zero_copy_only=False)
    width = max(dim or 0, int(lens[good].max(initial=0)))
    rows = np.flatnonzero(good)
    out = np.zeros((len(rows), width))
    own = lens[rows]
    at = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
    out[np.repeat(np.arange(len(rows)), own), at] = np.floor(scale * flat[np.repeat(stop[rows] - own, own) + at])
    return (*(batch.column(n).to_numpy(zero_copy_only=False)[rows] for n in ("id", "label", "anchor")), out)


def blocks(batches, scale: int, dim: int, primes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Ids, labels and residues of the rows, a bounded number at once, ordered by label."""
    for batch in batches:
        ids, labels, _, vectors = parsed(batch, scale, dim)
        order = np.argsort(labels, kind="stable")
        step = CELLS // TILE
        for s in range(0, len(order), step):
            at = order[s:s + step]
            yield ids[at], labels[at], residues(vectors[at], primes)


def found_batches(best: Best, names: tuple[str, str, str]) -> Iterator[pa.RecordBatch]:
    best.settle()
    for s in range(0, len(best.key), 10_000):
        e = s + 10_000
        yield pa.RecordBatch.from_arrays([pa.array(x[s:e].astype(np.int64)) for x in (best.key, best.score, best.ident)], list(names))


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         scale: int = 256, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
         chunk: int = CHUNK) -> DataFrame:
    """(anchor_id, positive_id, positive_score, negative_id, negative_score, place) of hard negatives.

    Components x become floor(scale * x). For each row with ``anchor`` and
    each of its ``n_positives`` best other rows of the same label, the first
    ``n_negatives`` rows of other labels with low * positive_score <=
    100 * negative_score <= high * positive_score; higher scores come first,
    ties by smaller id, ``place`` counts them from 1.

    Rows with a null id, label or vector, or a null or non-finite component,
    take no part. Vectors shorter than the longest count as padded with zeros.
    Rows that share an id are no positives of each other. Of rows repeated
    whole, each may be a positive or negative, but they are one anchor.
    Scores must stay below 2^59 (a ValueError otherwise).
    """
    spark = rows.sparkSession
    src = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                      F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).alias("vec")) \
        .where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")

    def measured(batches):
        for b in batches:
            _, _, flags, vectors = parsed(b, scale)
            length = float((vectors ** 2).sum(1).max(initial=0))
            yield pa.RecordBatch.from_pylist([{"dim": vectors.shape[1], "length": length, "anchors": int(flags.sum())}])

    size = src.mapInArrow(measured, "dim bigint, length double, anchors bigint").agg(
        F.max("dim").alias("dim"), F.max("length").alias("length"), F.sum("anchors").alias("anchors")).first()
    dim, length, count = size.dim or 0, size.length or 0.0, size.anchors or 0
    if not length < LARGEST:
        raise ValueError("scores of these vectors do not fit 64 bits")
    primes = primes_for(dim, math.ceil(length * (1 + 1e-9)))
    n_chunks = max(1, -(-count // chunk))
    anchors = src.where("anchor").dropDuplicates(["id", "label", "vec"])
    parts = [_mine_chunk(spark, src, anchors.where(F.pmod(F.xxhash64("id", "vec"), F.lit(n_chunks)) == c), dim, primes, scale,
                         n_positives, n_negatives, low, high) for c in range(n_chunks)]
    return reduce(DataFrame.unionByName, parts)


def _mine_chunk(spark, src, anchors, dim, primes, scale, n_positives, n_negatives, low, high) -> DataFrame:
    """The result of a bounded number of anchors."""
    kept = [parsed(b, scale, dim) for b in anchors.toArrow().combine_chunks().to_batches()]
    if not sum(len(k[0]) for k in kept):
        return spark.createDataFrame([], FOUND)
    ids, labels, _, vectors = (np.concatenate(x) for x in zip(*kept, strict=True))
    order = np.lexsort((ids, labels))
    ids, labels, vectors = ids[order], labels[order], vectors[order]
    sent = spark.sparkContext.broadcast((ids, labels, residues(vectors, primes)))   # at most a chunk
    n = len(ids)

    def positives(batches):
        own_ids, own_labels, own = sent.value
        best = Best(n, n_positives, np.full(n, -LARGEST, np.int64))
        for row_ids, row_labels, rows in blocks(batches, scale, dim, primes):
            for label in np.unique(row_labels):
                s, e = np.searchsorted(own_labels, [label, label + 1])
                r0, r1 = np.searchsorted(row_labels, [label, label + 1])
                for t in range(s, e, TILE):
                    u = min(e, t + TILE)
                    x = scores([m[t:u] for m in own], [m[r0:r1] for m in rows], primes)
                    a, r = np.nonzero((x >= best.least[t:u, None]) & (own_ids[t:u, None] != row_ids[None, r0:r1]))
                    best.add(a + t, x[a, r].astype(np.int64), row_ids[r0 + r])
        yield from found_batches(best, ("key", "score", "id"))

    def first(found, k):
        by = Window.partitionBy("key").orderBy(F.desc("score"), "id")
        return found.withColumn("place", F.row_number().over(by)).where(F.col("place") <= k)

    pos = first(src.mapInArrow(tidied(positives), "key bigint, score bigint, id bigint"), n_positives).toArrow()
    key, place, score, ident = (pos.column(c).to_numpy() for c in ("key", "place", "score", "id"))
    slot = key * n_positives + place - 1       # a window per anchor and positive
    least, most = np.full(n * n_positives, LARGEST, np.int64), np.full(n * n_positives, -LARGEST, np.int64)
    whole = [int(s) for s in score]            # unbounded integers: the products may pass 64 bits
    least[slot] = [-(-low * s // 100) for s in whole]
    most[slot] = [high * s // 100 for s in whole]
    positive = np.zeros((2, n * n_positives), np.int64)
    positive[:, slot] = ident, score
    windows = spark.sparkContext.broadcast((least, most, positive))

    def negatives(batches):
        own_ids, own_labels, own = sent.value
        least, most, positive = windows.value
        best = Best(n * n_positives, n_negatives, least)
        highest = most.reshape(n, n_positives).max(1)
        for row_ids, row_labels, rows in blocks(batches, scale, dim, primes):
            for t in range(0, n, TILE):
                u = min(n, t + TILE)
                x = scores([m[t:u] for m in own], rows, primes)
                lowest = best.least[t * n_positives:u * n_positives].reshape(-1, n_positives).min(1)
                a, r = np.nonzero((x >= lowest[:, None]) & (x <= highest[t:u, None]) & (own_labels[t:u, None] != row_labels[None, :]))
                found = x[a, r].astype(np.int64)
                for w in range(n_positives):
                    key = (a + t) * n_positives + w
                    fits = (found >= best.least[key]) & (found <= most[key])
                    best.add(key[fits], found[fits], row_ids[r[fits]])
            best.settle()
        for b in found_batches(best, ("key", "score", "id")):
            k = b.column("key").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pa.array(own_ids[k // n_positives]), pa.array(positive[0, k]), pa.array(positive[1, k]),
                 b.column("id"), b.column("score")], ["key", "anchor_id", "positive_id", "positive_score", "id", "score"])

    found = src.mapInArrow(tidied(negatives), "key bigint, anchor_id bigint, positive_id bigint, positive_score bigint, id bigint, score bigint")
    return first(found, n_negatives).select(
        "anchor_id", "positive_id", "positive_score", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"),
        F.col("place").cast("bigint").alias("place"))
