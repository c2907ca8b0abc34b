"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in two halves with a codebook each; the pairs of
codewords are the cells of a product grid. For every vector the cells are
visited in order of their summed distance (multi-sequence order) until a
number that reaches the target recall for pairs at the threshold, measured on
a sample. Only vectors met in a visited cell are multiplied, in double
precision. Equal vectors of a label are one class and are compared once.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from quarry.llm.common import checkpointed, tidied
from quarry.llm.components import connected_components
from quarry.operators.joins import bounded_broadcast

THRESHOLD = 0.93
SAMPLE = 4096           # vectors the codebooks are fitted on
HELD = 2000             # further vectors, unseen by the codebooks, for the number of visits
PER_CELL = 32           # vectors wished for in a cell of one label
MAX_CODES = 256
TARGET = 0.999          # share of pairs at the very threshold that must meet
CHUNK = 16384           # index vectors held at once by a task,
CHUNK_BYTES = 8 << 20   # of at most so many bytes
PROBES, BLOCK = 1024, 2048   # probes and vectors of a cell multiplied at once
TILE_ROWS = 200_000     # up to so many sizes of tiles are broadcast
SALTS = 16              # parts of a class of equal vectors when its answer is sent to its members


def unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means centres of a bounded sample, begun at spread-out rows."""
    rng = np.random.default_rng(5)
    centres = x[rng.choice(len(x), k, replace=len(x) < k)]
    for _ in range(rounds):
        near = distances(x, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)[:, None]
        centres = np.where(n > 0, sums / np.maximum(n, 1), centres)
    # codewords that lie near each other get near numbers, so the cells of a visit share tiles
    axis = np.linalg.svd(centres - centres.mean(0), full_matrices=False)[2][0]
    return centres[np.argsort(centres @ axis, kind="stable")]


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * x @ centres.T)


class Grid:
    """Two codebooks and the number of cells a vector visits."""

    def __init__(self, sample: np.ndarray, codes: int, threshold: float = THRESHOLD, target: float = TARGET):
        self.half = sample.shape[1] // 2
        held = min(HELD, len(sample) // 3)
        sample, unseen = np.split(sample, [len(sample) - held]) if held else (sample, sample)
        self.books = [codebook(sample[:, :self.half], codes), codebook(sample[:, self.half:], codes)]
        self.codes = codes
        self.visits = codes * codes
        # partners of unseen vectors at exactly the threshold, in random directions
        rng = np.random.default_rng(6)
        x = np.resize(unseen, (HELD, sample.shape[1]))   # few vectors have several partners
        side = rng.standard_normal(x.shape)
        side = unit(side - (side * x).sum(1, keepdims=True) * x)
        y = threshold * x + np.sqrt(1 - threshold ** 2) * side
        rank = np.concatenate([np.minimum(self.rank(x[k:k + 64], y[k:k + 64]), self.rank(y[k:k + 64], x[k:k + 64]))
                               for k in range(0, HELD, 64)])
        missed = (1 - target) * HELD
        missed = max(0, int(missed - 2 * np.sqrt(missed)))   # two standard errors on the safe side
        self.visits = int(np.sort(rank)[HELD - 1 - missed]) + 1

    def rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The place of y's cell among the cells that x visits."""
        return (self.visit_order(x) == self.cell(y)[:, None]).argmax(1)

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Summed distance of every vector to every cell."""
        a, b = distances(x[:, :self.half], self.books[0]), distances(x[:, self.half:], self.books[1])
        return (a[:, :, None] + b[:, None, :]).reshape(len(x), -1)

    def cell(self, x: np.ndarray) -> np.ndarray:
        a, b = distances(x[:, :self.half], self.books[0]), distances(x[:, self.half:], self.books[1])
        return a.argmin(1) * self.codes + b.argmin(1)

    def visit_order(self, x: np.ndarray) -> np.ndarray:
        """The first ``visits`` cells in multi-sequence order, nearest first.

        Only the cells (i, j) of the i-th and j-th nearest codewords with
        (i + 1)(j + 1) <= visits can be among them: all cells in front of a
        cell in both orders come before it.
        """
        a, b = distances(x[:, :self.half], self.books[0]), distances(x[:, self.half:], self.books[1])
        ia, ib = a.argsort(1, kind="stable"), b.argsort(1, kind="stable")
        i, j = np.divmod(np.arange(self.codes ** 2), self.codes)
        front = (i + 1) * (j + 1) <= self.visits
        i, j = i[front], j[front]
        total = np.take_along_axis(a, ia, 1)[:, i] + np.take_along_axis(b, ib, 1)[:, j]
        first = total.argsort(1, kind="stable")[:, :self.visits]
        return np.take_along_axis(ia[:, i] * self.codes + ib[:, j], first, 1)


def _unit_vectors(col: pa.Array, code: str) -> np.ndarray:
    """Unit vectors in double precision of a column of packed components (type ``code``)."""
    x = np.frombuffer(b"".join(col.to_pylist()), code).astype(np.float64).reshape(len(col), -1)
    return unit(x / np.abs(x).max(1, keepdims=True))   # no square overflows or vanishes


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str, dim: int, code: str) -> DataFrame:
    """(id, label, digest, x: packed components) of the rows that can be linked."""
    src = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                      F.col(vector_col).cast("array<float>" if code == "<f4" else "array<double>").alias("v")) \
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") == dim))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column("v")
            x = v.flatten().to_numpy(zero_copy_only=False).astype(code).reshape(b.num_rows, dim)   # null components are NaN here
            good = np.isfinite(x).all(1) & (x != 0).any(1)
            keep = pa.array(good)
            raw = [r.tobytes() for r in x[good] + 0.0]   # -0 is 0
            yield pa.RecordBatch.from_arrays(
                [b.column("id").filter(keep), b.column("label").filter(keep),
                 pa.array([hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary()), pa.array(raw, pa.binary())],
                ["id", "label", "digest", "x"])

    return src.mapInArrow(tidied(run), "id bigint, label bigint, digest binary, x binary")


def _placed(classes: DataFrame, grid: Grid, code: str) -> DataFrame:
    """Every class with its cell and the cells it visits (packed 32-bit numbers, nearest first)."""
    shared = classes.sparkSession.sparkContext.broadcast(grid)   # two codebooks of MAX_CODES rows at most

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                x = _unit_vectors(part.column("x"), code)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(shared.value.cell(x).astype(np.int32)),
                     pa.array([v.tobytes() for v in shared.value.visit_order(x).astype("<i4")], pa.binary())],
                    [*part.schema.names, "cell", "visits"])

    return classes.mapInArrow(tidied(run), "label bigint, digest binary, rep bigint, n bigint, x binary, cell int, visits binary")


class Chunk:
    """Index vectors of one chunk of a tile, ordered by cell, and what the probes have linked."""

    def __init__(self, table: pa.RecordBatch, code: str, threshold: float):
        cell = table.column("cell").to_numpy()
        table = table.take(pa.array(np.argsort(cell, kind="stable")))
        self.code, self.threshold = code, threshold
        self.digest = np.array(table.column("digest").to_pylist(), "V16")
        self.rep, self.n = table.column("rep").to_numpy(), table.column("n").to_numpy()
        self.x = _unit_vectors(table.column("x"), code)
        self.visits = _cells(table.column("visits"))
        self.cells, self.starts = np.unique(table.column("cell").to_numpy(), return_index=True)
        self.ends = np.append(self.starts[1:], len(self.x))
        self.comp = np.arange(len(self.x))
        self.back = np.zeros(len(self.x), np.int64)   # links that only the probe's visits found
        self.products = 0

    def compare(self, probes: pa.RecordBatch) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Links of every probe (weighted by class sizes), and edges that join what was apart."""
        x, cell, went = _unit_vectors(probes.column("x"), self.code), probes.column("cell").to_numpy(), _cells(probes.column("visits"))
        digest, rep, n = np.array(probes.column("digest").to_pylist(), "V16"), probes.column("rep").to_numpy(), probes.column("n").to_numpy()
        count, edges = np.zeros(len(x), np.int64), []
        at = np.minimum(np.searchsorted(self.cells, went), len(self.cells) - 1)
        who, slot = np.nonzero(self.cells[at] == went)               # visits of cells that hold vectors here
        at = at[who, slot]
        order = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.diff(at[order])) + 1
        for visit in np.split(order, cuts) if len(order) else ():
            rows, c = who[visit], at[visit[0]]
            for lo in range(self.starts[c], self.ends[c], BLOCK):
                hi = min(lo + BLOCK, self.ends[c])
                self.products += len(rows) * (hi - lo)
                i, j = np.nonzero(x[rows] @ self.x[lo:hi].T >= self.threshold)
                i, j = rows[i], j + lo
                other = digest[i] != self.digest[j]
                i, j = i[other], j[other]
                if not len(i):
                    continue
                np.add.at(count, i, self.n[j])
                for k in range(0, len(i), 1 << 16):
                    pi, pj = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
                    alone = ~(self.visits[pj] == cell[pi][:, None]).any(1)   # not visited from the other side
                    np.add.at(self.back, pj[alone], n[pi[alone]])
                for p, near in zip(i[np.append(0, np.flatnonzero(np.diff(i)) + 1)].tolist(), np.split(j, np.flatnonzero(np.diff(i)) + 1), strict=True):
                    roots = np.unique(self.comp[near])
                    edges.append((int(rep[p]), int(self.rep[roots[0]])))
                    for r in roots[1:].tolist():
                        edges.append((int(self.rep[r]), int(self.rep[roots[0]])))
                        self.comp[self.comp == r] = roots[0]
        return count, edges


def _cells(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<i4").reshape(len(col), -1)


def _compare(threshold: float, code: str):
    """Link counts and edges of the index rows of a chunk (first) and the probes that follow them."""
    def groups(batches):
        """Runs of rows of one (label, tile, chunk); an index row has probe = false."""
        for b in batches:
            key = list(zip(*(b.column(c).to_pylist() for c in ("label", "tile", "chunk", "probe")), strict=True))
            start = 0
            for k in range(1, len(key) + 1):
                if k == len(key) or key[k] != key[start]:
                    yield key[start], b.slice(start, k - start)
                    start = k

    def emit(label, digest, n, edges=()):
        some = np.flatnonzero(n)
        rows, joins = len(some), len(edges)
        return pa.RecordBatch.from_arrays(
            [pa.array([label] * rows + [None] * joins, pa.int64()), pa.array([digest[i].tobytes() for i in some] + [None] * joins, pa.binary()),
             pa.array(n[some].tolist() + [None] * joins, pa.int64()),
             pa.array([None] * rows + [a for a, _ in edges], pa.int64()), pa.array([None] * rows + [b for _, b in edges], pa.int64())],
            ["label", "digest", "n", "a", "b"])

    def run(batches):
        key, held, chunk = None, [], None
        for (*place, probe), rows in groups(batches):
            if place != key:
                if chunk is not None:
                    yield emit(key[0], chunk.digest, chunk.back)
                key, held, chunk = place, [], None
            if not probe:
                held.append(rows)
                continue
            if held:
                chunk, held = Chunk(pa.Table.from_batches(held).combine_chunks().to_batches()[0], code, threshold), []
            if chunk is None:
                continue   # no index vector hashed to this chunk
            for k in range(0, rows.num_rows, PROBES):
                part = rows.slice(k, PROBES)
                count, edges = chunk.compare(part)
                if count.any():
                    yield emit(key[0], np.array(part.column("digest").to_pylist(), "V16"), count, edges)
        if chunk is not None:
            yield emit(key[0], chunk.digest, chunk.back)

    return run


def links(classes: DataFrame, grid: Grid, code: str, threshold: float = THRESHOLD) -> DataFrame:
    """(label, digest, n) partial link counts of classes and (a, b) edges that span what the links connect.

    The grid is cut into square tiles of cells that hold about ``CHUNK``
    vectors of the fullest label; a tile that holds more of a label is dealt
    in chunks. A task holds one chunk ordered by cell. A vector is sent once
    to every chunk of the tiles it visits, whatever the number of cells it
    visits there, and is multiplied with the vectors of those cells only; no
    pair is ever written. A pair that only one side's visits bring together is
    counted for the other side as well.
    """
    per = max(PER_CELL, min(CHUNK, CHUNK_BYTES // (16 * grid.half)))
    tiles = math.ceil(grid.codes / max(1, math.isqrt(per // PER_CELL)))
    side = math.ceil(grid.codes / tiles)
    codes = grid.codes
    placed = _placed(classes, grid, code)

    def tiled(batches):
        for b in batches:
            if not b.num_rows:
                continue
            number = lambda c: c // codes // side * tiles + c % codes // side
            went = number(_cells(b.column("visits")))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(number(b.column("cell").to_numpy()), pa.int32()),
                 pa.array([np.unique(w).tolist() for w in went], pa.list_(pa.int32()))], [*b.schema.names, "tile", "tiles"])

    schema = "label bigint, digest binary, rep bigint, n bigint, x binary, cell int, visits binary"
    placed = checkpointed(placed.mapInArrow(tidied(tiled), f"{schema}, tile int, tiles array<int>"))
    sizes = bounded_broadcast(checkpointed(placed.groupBy("label", "tile").agg(F.ceil(F.count(F.lit(1)) / per).cast("int").alias("chunks"))), TILE_ROWS)
    columns = ["label", "tile", "chunk", "probe", "digest", "rep", "n", "x", "cell", "visits"]
    index = (placed.join(sizes, ["label", "tile"])
             .withColumns({"chunk": F.pmod(F.xxhash64("digest"), F.col("chunks")).cast("int"), "probe": F.lit(False)}))
    probes = (placed.drop("tile").withColumn("tile", F.explode("tiles")).join(sizes, ["label", "tile"])
              .withColumns({"chunk": F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)), "probe": F.lit(True)}))
    return (index.select(*columns).unionByName(probes.select(*columns))
            .repartition("label", "tile", "chunk").sortWithinPartitions("label", "tile", "chunk", "probe")
            .mapInArrow(tidied(_compare(threshold, code)), "label bigint, digest binary, n bigint, a bigint, b bigint"))


def fit(classes: DataFrame, code: str, threshold: float = THRESHOLD, sample: int = SAMPLE) -> Grid | None:
    """Codebooks on at most ``sample`` vectors, visits on ``HELD`` others, of the least digests; None without vectors.

    The grid is as fine as the label with most vectors asks for.
    """
    most = classes.groupBy("label").count().agg(F.max("count").alias("most")).first().most
    if not most:
        return None
    got = classes.orderBy(F.xxhash64("digest"), "digest", "label").limit(sample + HELD).select("x").collect()   # a bounded sample
    codes = int(np.clip(np.ceil(np.sqrt(most / PER_CELL)), 2, MAX_CODES))
    return Grid(_unit_vectors(pa.array([r.x for r in got], pa.binary()), code), codes, threshold)


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links bigint, component_id bigint, kept boolean) for every input row.

    Vectors of one label with a cosine of at least ``threshold`` are linked.
    Vectors that are null, zero, hold a null or non-finite component, differ
    in length from the table's most common one, or have a null label or id
    link with nothing. Rows that repeat an id with the same vector are one
    vector; other vectors under one id share that id's node and their links
    are summed. A null id has no component and is kept.

    Equal vectors of a label are one class: it is compared once, and counts
    for as many links as it has ids.
    """
    kind = rows.schema[vector_col].dataType
    code = "<f4" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "<f8"
    ids = rows.select(F.col(id_col).cast("bigint").alias("id"), F.size(F.col(vector_col)).alias("d"))
    dim = ids.where("d > 0").groupBy("d").count().orderBy(F.desc("count"), "d").first()
    out = rows.select(F.col(id_col).cast("bigint").alias("id"))
    valid = valid_vectors(rows, id_col, vector_col, label_col, dim.d if dim else 0, code)
    members = checkpointed(valid.select("id", "label", "digest").distinct())
    # both sides are dealt by class, so the vectors are shuffled once
    classes = (valid.groupBy("label", "digest").agg(F.min("id").alias("rep"), F.first("x").alias("x"))
               .join(members.groupBy("label", "digest").agg(F.count(F.lit(1)).alias("n")), ["label", "digest"]))
    classes = checkpointed(classes.select("label", "digest", "rep", "n", "x"))
    grid = fit(classes, code, threshold)
    if grid is None:
        nothing = F.lit(0).cast("bigint")
        return out.select(F.col("id").alias(id_col), nothing.alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    partial = checkpointed(links(classes, grid, code, threshold))
    key = ["label", "digest"]
    counts = partial.where("n IS NOT NULL").groupBy(*key).agg(F.sum("n").alias("links"))
    shared = members.groupBy("id").count().where("count > 1").select("id")   # ids of several vectors
    edges = partial.where("a IS NOT NULL").select("a", "b").unionByName(
        members.join(shared, "id").join(classes.select(*key, "rep"), key).select(F.col("id").alias("a"), F.col("rep").alias("b")))
    comps = connected_components(edges).withColumnsRenamed({"node": "rep", "component": "component_id"})
    part = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    parts = F.when(F.col("n") > 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")))
    answers = (classes.drop("x").join(counts.hint("merge"), key, "left").join(comps.hint("merge"), "rep", "left")
               .select(*key, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                       F.coalesce("component_id", "rep").alias("component_id"), F.explode(parts).alias("part")))
    found = (members.withColumn("part", part).join(answers.hint("merge"), [*key, "part"])
             .groupBy("id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id")))
    return (out.join(found, "id", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"),
                    F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept")))
