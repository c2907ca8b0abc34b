"""Near-duplicate documents: SuperMinHash signatures, banding, verification, union-find.

Every shingle ranks the signature's slots by a random permutation; at rank j
it offers the slot of that rank the value j + r with r uniform in [0, 1). A
slot keeps the least offer. Because one shingle's offers to different slots
are tied to one permutation, slots are negatively correlated and the estimate
varies less than with independent hashes; a document is finished at the first
rank that no slot's value exceeds, after one or two ranks for most texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed, mix64, release, row_blocks, texts_of, tidied, tidied_group
from quarry.llm.components import connected_components
from quarry.llm.shingles import shingle_sets
from quarry.operators.joins import bounded_broadcast

SLOTS, BANDS = 128, 32        # 4 slots a band: a pair at 0.75 shares none with probability 5e-6
PERCENT = 75                  # link: 100 * intersection >= PERCENT * union
SMALL = 256                   # candidate clusters up to this size are verified in one task
LEADERS = 4                   # of a larger cluster, verified against all its members first
MEMBER_ROWS = 500_000         # up to so many cluster members (16 bytes each) are broadcast to the scan of the texts
CHUNK_U, CHUNK_V = 128, 1024  # members of a larger cluster that meet in one task

_BANK_BITS = 14
_bank: list[np.ndarray] = []


def permutations(slots: int) -> np.ndarray:
    """2^14 random permutations of the slots, the same in every task."""
    if not _bank or _bank[0].shape[1] != slots:
        _bank[:] = [np.argsort(np.random.default_rng(11).random((1 << _BANK_BITS, slots), np.float32), axis=1).astype(np.uint8)]
    return _bank[0]


def superminhash(elements: np.ndarray, sizes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures (texts x slots, uint64: rank in the upper half, r in the lower) of many sets."""
    n = len(sizes)
    bank = permutations(slots)
    doc = np.repeat(np.arange(n), sizes)
    row = (mix64(elements ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(64 - _BANK_BITS)).astype(np.int64)
    sig = np.full(n * slots, np.iinfo(np.uint64).max, np.uint64)
    for j in range(slots):
        if not len(elements):
            break
        r = mix64(elements + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(32)
        np.minimum.at(sig, doc * slots + bank[row, j], r | np.uint64(j << 32))
        going = np.unique(doc)
        going = going[sig.reshape(n, slots)[going].max(1) >= np.uint64((j + 1) << 32)]   # else no later rank can lower a slot
        left = np.zeros(n, bool)
        left[going] = True
        left = left[doc]
        elements, doc, row = elements[left], doc[left], row[left]
    return sig.reshape(n, slots)


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band (texts x bands); the band's number is part of it."""
    parts = sig.reshape(len(sig), bands, -1)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(parts.shape[2]):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets reach the similarity."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    both = int(np.count_nonzero(a[np.minimum(at, len(a) - 1)] == b))
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketch(docs: DataFrame, id_col: str, text_col: str, with_set: bool = False, extra: str = "") -> DataFrame:
    """(id, n, digest of the set, band keys[, the set]) of every row; ``extra`` is carried along."""
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), *([extra] if extra else []))

    def run(batches):
        for b in batches:
            texts = texts_of(b, "text")
            for part in row_blocks(texts):
                elements, sizes = shingle_sets(texts[part])
                keys = band_keys(superminhash(elements, sizes))
                cuts = np.cumsum(sizes)[:-1]
                raw = [x.astype("<u8").tobytes() for x in np.split(elements, cuts)]
                some = sizes > 0
                digests = [hashlib.blake2b(x, digest_size=16).digest() if x else None for x in raw]
                off = np.concatenate([[0], np.cumsum(np.where(some, keys.shape[1], 0))]).astype(np.int32)
                n = part.stop - part.start
                cols = [b.column("id").slice(part.start, n), pa.array(sizes.astype(np.int64)), pa.array(digests, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(off), pa.array(keys[some].ravel()))]
                names = ["id", "n", "digest", "bands"]
                if with_set:
                    cols.append(pa.array(raw, pa.binary()))
                    names.append("elements")
                if extra:
                    cols.append(b.column(extra).slice(part.start, n))
                    names.append(extra)
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "id bigint, n bigint, digest binary, bands array<bigint>"
    return src.mapInArrow(tidied(run), schema + (", elements binary" if with_set else "") + (f", {extra} bigint" if extra else ""))


def _forest(ids, comps, bands, sets, left, right) -> list[tuple[int, int]]:
    """Verified links that join different components among left x right members sharing a band.

    Pairs that earlier links already connect are not compared.
    """
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    inverted: dict[int, list[int]] = {}
    for v in right:
        for key in bands[v]:
            inverted.setdefault(key, []).append(v)
    out = []
    for u in left:
        tried = set()
        for key in bands[u]:
            for v in inverted.get(key, ()):
                if v == u or v in tried:
                    continue
                tried.add(v)
                x, y = find(comps[u]), find(comps[v])
                if x != y and linked(sets[u], sets[v]):
                    parent[x] = y
                    out.append((ids[u], ids[v]))
    return out


def _verify_group(table: pa.Table) -> pa.Table:
    ids, comps = table.column("id").to_pylist(), table.column("comp").to_pylist()
    bands = table.column("bands").to_pylist()
    sets = [np.frombuffer(x, "<u8") for x in table.column("elements").to_pylist()]
    is_u, is_v = table.column("is_u").to_pylist(), table.column("is_v").to_pylist()
    found = _forest(ids, comps, bands, sets, [i for i, x in enumerate(is_u) if x], [i for i, x in enumerate(is_v) if x])
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def _leader_links(members: DataFrame, leaders: DataFrame) -> DataFrame:
    """Links of the members of large clusters with their cluster's few leaders."""
    sets = leaders.groupBy("cluster").agg(F.collect_list(F.struct("id", "elements")).alias("leaders"))   # LEADERS at most

    def run(batches):
        for b in batches:
            out = []
            own = [np.frombuffer(x, "<u8") for x in b.column("elements").to_pylist()]
            for i, mine, heads in zip(b.column("id").to_pylist(), own, b.column("leaders").to_pylist(), strict=True):
                out += [(i, h["id"]) for h in heads if h["id"] != i and linked(mine, np.frombuffer(h["elements"], "<u8"))]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

    return members.join(sets, "cluster").select("id", "elements", "leaders").mapInArrow(tidied(run), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: str = "") -> DataFrame:
    """(id, n_shingles bigint, component_id bigint, kept boolean) for every input row.

    Documents whose sets of five-word shingles have a similarity of 0.75 or
    more are linked; ``component_id`` is the least id reachable over links and
    ``kept`` marks that id itself. Candidates are documents that share a band
    of their signatures; every link is confirmed on the full sets. Nothing is
    capped:

    1. rows with equal sets are one class (grouped by a digest, combined
       map-side); only the class's least id goes on;
    2. band buckets join each member with the bucket's least id, and the
       components of these stars are the candidate clusters;
    3. a cluster of up to ``SMALL`` members is verified in one task. Of a
       larger one, all members are verified against ``LEADERS`` members that
       share most buckets; members outside the largest component found then
       meet all members in chunks of bounded size;
    4. the components of the confirmed links are the result.

    Null and empty texts and texts without words have no shingles and are
    linked with nothing. Rows that repeat an id with its text are answered each
    alike; other texts under one id share that id's node. Rows with a null id
    are answered with a null component and kept.

    With ``carry``, a bigint column of ``docs``, that column and the digest of
    the row's set (null without shingles) are returned too.
    """
    scan = checkpointed(sketch(docs, id_col, text_col, extra=carry))
    reps = (scan.where("id IS NOT NULL AND n > 0").groupBy("digest")
            .agg(F.min("id").alias("rep"), F.first("bands").alias("bands")))
    reps = checkpointed(reps)
    banded = reps.select("rep", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1")
    stars = checkpointed(banded.join(buckets.hint("merge"), "key").groupBy("rep", "head").agg(F.sum("size").alias("mates")))
    clusters = connected_components(stars.select(F.col("rep").alias("a"), F.col("head").alias("b")))
    mates = stars.groupBy("rep").agg(F.sum("mates").alias("mates"))
    sizes = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    placed = checkpointed(clusters.join(sizes.hint("merge"), "component").join(mates.withColumnRenamed("rep", "node").hint("merge"), "node")
                          .select("node", F.col("component").alias("cluster"), "size", "mates"))

    release(docs.sparkSession)

    wanted = placed.join(reps.select(F.col("rep").alias("node"), "digest").hint("merge"), "node")
    texts = docs.select(F.col(id_col).cast("bigint").alias("node"), F.col(text_col).alias("text"))
    chosen = texts.join(bounded_broadcast(wanted.select("node", "cluster").distinct(), MEMBER_ROWS), "node")
    sets = (sketch(chosen, "node", "text", with_set=True, extra="cluster")
            .join(wanted.select(F.col("node").alias("id"), "digest", "size", "mates"), ["id", "digest"])
            .dropDuplicates(["id", "digest"])
            .withColumn("comp", F.col("id")))
    columns = ["id", "comp", "bands", "elements", "is_u", "is_v"]
    small = (sets.where(F.col("size") <= SMALL)
             .withColumns({"is_u": F.lit(True), "is_v": F.lit(True)}).select("cluster", *columns))
    links = small.groupBy("cluster").applyInArrow(tidied_group(_verify_group), "a bigint, b bigint")

    if not placed.where(F.col("size") > SMALL).isEmpty():
        links = checkpointed(links)
        large = checkpointed(sets.where(F.col("size") > SMALL))
        order = Window.partitionBy("cluster").orderBy(F.desc("mates"), "id", "digest")
        leaders = large.select("cluster", "id", "digest", "mates").withColumn("place", F.row_number().over(order)).where(F.col("place") <= LEADERS)
        leaders = large.join(leaders.select("cluster", "id", "digest").hint("merge"), ["cluster", "id", "digest"])
        by_leader = checkpointed(_leader_links(large, leaders))
        comps = connected_components(by_leader)
        members = large.drop("comp").join(comps.select(F.col("node").alias("id"), F.col("component").alias("comp")), "id", "left") \
            .withColumn("comp", F.coalesce("comp", "id"))
        counts = members.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))   # one size per cluster
        salts = F.ceil(F.col("size") / CHUNK_V)   # a cluster's members go to many tasks
        main = counts.groupBy("cluster").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("n").alias("n_v"),
                                             (F.sum("n") - F.max("n")).alias("n_u"), F.first("size").alias("size"))
        main = main.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))).drop("size")
        members = checkpointed(members.withColumn("salt", F.pmod(F.xxhash64("id", "digest"), salts))
                               .join(main.hint("merge"), ["cluster", "salt"]).drop("salt"))
        chunk = lambda per, n: F.pmod(F.xxhash64("id", "digest"), F.greatest(F.lit(1), F.ceil(F.col(n) / per)))
        spread = lambda per, n: F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.col(n) / per)) - 1))
        open_ = members.where("n_u > 0")
        left = open_.where("comp <> main").withColumns({"uc": chunk(CHUNK_U, "n_u"), "is_u": F.lit(True), "is_v": F.lit(False)}) \
            .withColumn("vc", spread(CHUNK_V, "n_v"))
        right = open_.withColumns({"vc": chunk(CHUNK_V, "n_v"), "is_u": F.lit(False), "is_v": F.lit(True)}) \
            .withColumn("uc", spread(CHUNK_U, "n_u"))
        rest = (left.select("cluster", "uc", "vc", *columns).unionByName(right.select("cluster", "uc", "vc", *columns))
                .groupBy("cluster", "uc", "vc").applyInArrow(tidied_group(_verify_group), "a bigint, b bigint"))
        links = links.unionByName(by_leader).unionByName(rest)

    release(docs.sparkSession)
    comps = connected_components(links).withColumnsRenamed({"node": "rep", "component": "component_id"})
    classes = reps.select("digest", "rep").join(comps.hint("merge"), "rep", "left") \
        .select("digest", F.coalesce("component_id", "rep").alias("component_id"))
    own = scan.select("id", "n", "digest", *([carry] if carry else []))
    joined = own.join(classes.hint("merge"), "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                         F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"), *([carry, "digest"] if carry else []))
