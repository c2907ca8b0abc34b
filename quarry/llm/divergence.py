"""How the sources of a language differ in their words, by sorting pointers to word starts.

A task looks at its documents through the Arrow buffers: every word is a
pointer to its first byte. The pointers of a slice are sorted by multikey
quicksort with eight bytes as a key, (language, source) first; words that are
settled leave the sort, the others go on with their next eight bytes. Equal
runs give a word's occurrences per source and its document frequency. Only
these counts are shuffled. From there on all arithmetic is on integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed, tidied, tidied_group

SLICE_BYTES = 16 << 20   # text whose pointers are sorted at once; a longer text is a slice of its own
DEEP = 64                # bytes of a word compared as keys; what is equal so far is sorted as byte strings
BUCKET_ROWS = 50_000     # counts of a language compared in one group, about
CELLS = 4 << 20          # pairs of sources, or probabilities, that a group holds at once
ROWS_OUT = 50_000

_BYTES = np.arange(256)
#: Words are runs of ASCII letters and of everything beyond ASCII; only A-Z are lower-cased.
WORD = (_BYTES >= 0x80) | ((_BYTES | 0x20 >= 0x61) & (_BYTES | 0x20 <= 0x7A) & (_BYTES >= 0x41))
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)


def word_pointers(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, length and document of every word; document k begins at starts[k], none is crossed."""
    inside = WORD[data]
    edge = starts[(starts > 0) & (starts < len(data))]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[edge], after[edge - 1] = False, False
    first = np.flatnonzero(inside & ~before)
    return first, np.flatnonzero(inside & ~after) + 1 - first, np.searchsorted(starts, first, "right") - 1


def sorted_runs(data: np.ndarray, first: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of words by (group, bytes), stable, and where runs of equal ones begin in it."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(data) + 1, 8), (1, 1))

    def keys(words, depth):
        rest = np.clip(size[words] - depth, 0, 8)
        at = np.minimum(first[words] + depth, len(data))
        key = eight[at].copy().view(">u8").ravel().astype(np.uint64)
        shift = (8 * (8 - rest)).astype(np.uint64)
        return np.where(rest > 0, key >> (shift % np.uint64(64)) << (shift % np.uint64(64)), np.uint64(0))

    n = len(first)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    key = keys(np.arange(n), 0)
    order = np.lexsort((key, group))
    new = np.ones(n, bool)
    k, g = key[order], group[order]
    new[1:] = (k[1:] != k[:-1]) | (g[1:] != g[:-1])
    places, depth = np.arange(n), 8

    def open_places(places, depth):
        """Those in runs of more than one word where some word goes on."""
        begin = np.flatnonzero(new[places])
        length = np.diff(np.append(begin, len(places)))
        goes_on = (np.maximum.reduceat(size[order[places]], begin) > depth) & (length > 1)
        return places[np.repeat(goes_on, length)]

    while len(places := open_places(places, depth)) and depth < DEEP:
        words, run = order[places], np.cumsum(new[places])
        key = keys(words, depth)
        by = np.lexsort((key, run))
        order[places] = words[by]
        k = key[by]
        new[places[1:]] |= (k[1:] != k[:-1]) & (run[1:] == run[:-1])
        depth += 8
    if len(places):
        words, run = order[places].tolist(), np.cumsum(new[places]).tolist()
        raw = [data[first[w] + depth:first[w] + size[w]].tobytes() for w in words]
        by = sorted(range(len(words)), key=lambda i: (run[i], raw[i]))
        order[places] = [words[i] for i in by]
        for a, b, at in zip(by, by[1:], places[1:].tolist(), strict=False):
            new[at] |= run[a] == run[b] and raw[a] != raw[b]
    return order, new


def run_counts(data: np.ndarray, starts: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(group, term, occurrences, documents) of the distinct words of each group; ``group`` is by document."""
    data = LOWER[data]
    first, size, doc = word_pointers(data, starts)
    order, new = sorted_runs(data, first, size, group[doc])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(order)))
    other = new.copy()
    by_doc = doc[order]
    other[1:] |= by_doc[1:] != by_doc[:-1]
    docs = np.add.reduceat(other.astype(np.int64), begin) if len(begin) else np.zeros(0, np.int64)
    word = order[begin]
    lens = size[word]
    stop = np.cumsum(lens)
    raw = data[np.arange(int(lens.sum())) + np.repeat(first[word] - (stop - lens), lens)]
    terms = pa.Array.from_buffers(pa.large_string(), len(word), [
        None, pa.py_buffer(np.concatenate([[0], stop]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))])
    return group[doc[word]], terms, count, docs


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term, in parts that add up.

    Null columns count as ''. Each row is a document, repeated ones too.
    """
    src = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            text = b.column("text").cast(pa.large_binary())
            off = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
            data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
            lang, source = (b.column(c).dictionary_encode() for c in ("lang", "source"))
            n_sources = max(1, len(source.dictionary))
            group = lang.indices.to_numpy().astype(np.int64) * n_sources + source.indices.to_numpy()
            row = 0
            while row < len(text):
                end = max(row + 1, int(np.searchsorted(off, off[row] + SLICE_BYTES, "right")) - 1)
                own, terms, n, df = run_counts(data[off[row]:off[end]], off[row:end] - off[row], group[row:end])
                for s in range(0, len(own), ROWS_OUT):
                    g = own[s:s + ROWS_OUT]
                    yield pa.RecordBatch.from_arrays(
                        [lang.dictionary.take(pa.array(g // n_sources)), source.dictionary.take(pa.array(g % n_sources)),
                         terms[s:s + ROWS_OUT].cast(pa.string()), pa.array(n[s:s + ROWS_OUT]), pa.array(df[s:s + ROWS_OUT])],
                        ["lang", "source", "term", "n", "docs"])
                row = end

    return src.mapInArrow(tidied(run), "lang string, source string, term string, n bigint, docs bigint")


def probability(count: str, total: str, kept: str, scale: int, smooth: int) -> Column:
    """1 + floor(scale * (count + smooth) / (total + smooth * kept)) in whole numbers of any size; null without kept terms."""
    return F.expr(f"1 + (CAST({scale} AS DECIMAL(12,0)) * (CAST({count} AS DECIMAL(19,0)) + {smooth})"
                  f" div nullif(CAST({total} AS DECIMAL(19,0)) + {smooth} * CAST({kept} AS DECIMAL(14,0)), 0))").cast("bigint")


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = 30,
          top: int = 50, scale: int = 1_000_000_000, smooth: int = 5) -> DataFrame:
    """(lang, source, part, item, value, rank) of the sources' divergence within their language.

    Kept are the terms in at least ``min_docs`` documents of their language.
    Every (lang, source) that occurs gives each kept term p = 1 + floor(scale *
    (count + smooth) / (N + smooth * V)), N its occurrences of kept terms, V
    their number. Part ``pair`` has each other source of the language, with
    the sum over all kept terms of the difference of the two p; part ``term``
    the ``top`` terms of the source that lie most above the language's own p.
    Ranks go by value, ties by the item's bytes. Null columns count as '',
    an empty table gives no rows.

    One shuffle moves the tasks' counts by (lang, term), so neither a hot
    source nor a hot word meets in one task. Pairs of sources are summed over
    groups of about ``BUCKET_ROWS`` counts; the result has a row per pair, and
    a group holds ``CELLS`` of them at most, however many sources there are.
    """
    spark = docs.sparkSession
    by_term = Window.partitionBy("lang", "term")
    counts = (term_counts(docs, lang_col, source_col, text_col).repartition("lang", "term")
              .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
              .select("lang", "term", "source", "n", F.sum("docs").over(by_term).alias("docs"), F.sum("n").over(by_term).alias("n_term"),
                      (F.min("source").over(by_term) == F.col("source")).alias("once"))
              .where(F.col("docs") >= min_docs))
    kept = checkpointed(counts.drop("docs"))
    sources = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source")))).distinct()
    langs = kept.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.count_if("once").alias("n_kept"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    groups = checkpointed(
        sources.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
        .join(sources.groupBy("lang").agg(F.count("*").alias("n_sources")), "lang").na.fill(0)
        .withColumn("unseen", probability("0", "n_group", "n_kept", scale, smooth)))
    given = (kept.join(groups, ["lang", "source"])
             .withColumn("p", probability("n", "n_group", "n_kept", scale, smooth)))

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    q = probability("n_term", "n_lang", "n_kept", scale, smooth)
    terms = (given.withColumn("value", F.col("p") - q).where("value > 0")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
             .withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top))

    n_buckets = max(1, -(-kept.count() // BUCKET_ROWS))
    parts = F.ceil(F.col("n_sources") * F.col("n_sources") / CELLS).cast("int")   # 1 up to 2,048 sources of a language
    all_parts = F.explode(F.sequence(F.lit(0), parts - 1)).alias("piece")
    left = given.select("lang", "source", "term", "p", F.pmod(F.xxhash64("term"), F.lit(n_buckets)).cast("int").alias("bucket"), all_parts)
    right = (groups.select("lang", "source", "unseen", parts.alias("parts"), all_parts)
             .select("*", (F.pmod(F.xxhash64("source"), F.col("parts")) == F.col("piece")).alias("own"))
             .withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(n_buckets - 1)))))

    def compare(given, groups):
        names = groups.column("source").combine_chunks()
        own = np.flatnonzero(groups.column("own").to_numpy())
        n = len(names)
        total = np.zeros((len(own), n), np.int64)
        if given.num_rows:
            unseen = groups.column("unseen").to_numpy()
            term = given.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
            source = pc.index_in(given.column("source"), value_set=names).to_numpy()
            p = given.column("p").to_numpy()
            order = np.argsort(term, kind="stable")
            step = max(1, CELLS // n)
            for t in range(0, int(term.max()) + 1, step):
                at = order[slice(*np.searchsorted(term[order], [t, t + step]))]
                grid = np.tile(unseen, (min(step, int(term.max()) + 1 - t), 1))
                grid[term[at] - t, source[at]] = p[at]
                for k, i in enumerate(own.tolist()):
                    total[k] += np.abs(grid - grid[:, i:i + 1]).sum(0)
        a, b = np.nonzero(own[:, None] != np.arange(n)[None, :])
        lang = groups.column("lang")[0].as_py()
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": names.take(pa.array(own[a])),
                         "item": names.take(pa.array(b)), "value": pa.array(total[a, b])})

    pairs = (left.groupBy("lang", "bucket", "piece").cogroup(right.groupBy("lang", "bucket", "piece"))
             .applyInArrow(tidied_group(compare), "lang string, source string, item string, value bigint")
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(by_value)))
    return pairs.unionByName(terms)
