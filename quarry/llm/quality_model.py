"""Quality classifier: nearest labelled neighbours in a latent-semantic space.

A text's terms are n-grams over the shapes of its characters (runs of small or
capital letters, digits, each punctuation mark itself) and marks of repetition
(a word equal to the one before, a line or a five-word window seen before), so
they describe form and not language. Term weights are projected on the leading
singular vectors of the labelled sample; every text is compared with every
labelled vector by blocked matrix products, and the nearest ones vote with
their cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import joined, mix64, row_blocks, texts_of, tidied
from quarry.llm.samples import per_class
from quarry.llm.shingles import word_hashes

TERMS = 2048
LATENT = 24
SAMPLE_PER_CLASS = 1000
NEIGHBOURS = 25
THRESHOLD = 0.7
_MARKS = 8                  # terms at the end for repetition, by tenths up to the whole
_REPEAT_WEIGHT = 12.0

_SHAPE = np.zeros(256, np.uint8)
_SHAPE[97:123] = 1
_SHAPE[128:] = 1
_SHAPE[65:91] = 2
_SHAPE[48:58] = 3
_SHAPE[[32, 9, 11, 12, 13]] = 4
_SHAPE[10] = 5
_punct = [c for c in range(33, 127) if not _SHAPE[c]]
_SHAPE[_punct] = 6 + np.arange(len(_punct))


def term_counts(texts: list[bytes]) -> np.ndarray:
    """Weights of the terms (texts x TERMS), each row of length 1 unless the text is empty."""
    n = len(texts)
    raw, off = joined(texts, b"\n")
    shape = _SHAPE[raw]
    doc = np.repeat(np.arange(n), np.diff(off))
    keep = np.ones(len(raw), bool)
    keep[1:] = (shape[1:] != shape[:-1]) | (shape[1:] > 3)   # runs of letters or digits are one shape
    shape, doc = shape[keep].astype(np.uint32), doc[keep]
    room = TERMS - _MARKS
    out = np.zeros(n * TERMS, np.float32)
    code = shape
    for size in range(1, 4):
        if size > 1:
            code = code[:-1] << 6 | shape[size - 1:]
        whole = doc[:len(code)] == doc[size - 1:]
        term = ((code[whole] + np.uint32(size << 20)) * np.uint32(0x9E3779B1) >> np.uint32(16)) * np.uint32(room) >> np.uint32(16)
        out += np.bincount(doc[:len(code)][whole] * TERMS + term, minlength=n * TERMS)
    out = out.reshape(n, TERMS)
    out[:, :room] = np.sqrt(out[:, :room] / np.maximum(1, out[:, :room].sum(1, keepdims=True)))
    out[:, room:] = repetition(texts)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(norm, 1e-12)


def repetition(texts: list[bytes]) -> np.ndarray:
    """Weights of the repetition marks (texts x _MARKS)."""
    words, counts = word_hashes(texts, fold=False)
    n = len(texts)
    doc = np.repeat(np.arange(n), counts)
    out = np.zeros((n, _MARKS), np.float32)
    size = np.maximum(1, counts)
    same = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    out[:, 0] = np.bincount(doc[1:][same], minlength=n) / size
    if len(words) >= 5:
        h = words[:-4].copy()
        for i in range(1, 5):
            h = h * np.uint64(0x9E3779B97F4A7C15) + words[i:len(words) - 4 + i]
        whole = doc[4:] == doc[:-4]
        own = doc[:-4][whole]
        key = np.unique(own.astype(np.uint64) << np.uint64(54) | mix64(h[whole]) >> np.uint64(10))
        distinct = np.bincount((key >> np.uint64(54)).astype(np.int64), minlength=n)
        total = np.bincount(own, minlength=n)
        out[:, 1] = (total - distinct) / size
    for k, t in enumerate(texts):
        lines = [x for x in t.split(b"\n") if x.strip()]
        out[k, 2] = 1 - len(set(lines)) / len(lines) if lines else 0
    out[:, 3] = counts == 0
    return out * np.float32(_REPEAT_WEIGHT ** 0.5)


class Model:
    """Projection, labelled vectors and labels; a few hundred KB."""

    def __init__(self, x: np.ndarray, y: np.ndarray, latent: int = LATENT):
        self.y = y.astype(np.float64)
        if not len(x):
            return
        df = (x > 0).mean(0)
        self.idf = (np.log((1 + len(x)) / (1 + len(x) * df)) + 1).astype(np.float32)
        w = x * self.idf
        w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12)
        gram = (w.T @ w).astype(np.float64)   # TERMS x TERMS
        basis = np.random.default_rng(3).standard_normal((TERMS, latent + 8))
        for _ in range(12):                   # subspace iteration to the leading singular vectors
            basis, _r = np.linalg.qr(gram @ basis)
        val, vec = np.linalg.eigh(basis.T @ gram @ basis)
        self.basis = (basis @ vec[:, ::-1][:, :latent]).astype(np.float32)
        self.vectors = self.project(x)
        self.balance = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))

    def project(self, x: np.ndarray) -> np.ndarray:
        z = (x * self.idf) @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled vectors."""
        if not len(self.y):
            return np.full(len(texts), 0.5)
        cos = self.project(term_counts(texts)) @ self.vectors.T   # the block x all labelled
        k = min(NEIGHBOURS, len(self.y))
        near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        sim = np.clip(np.take_along_axis(cos, near, 1), 1e-3, 1).astype(np.float64) ** 8 * self.balance[near]
        return np.clip((sim * self.y[near]).sum(1) / sim.sum(1), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", bound: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on at most ``bound`` labelled texts of each class, chosen by id hash.

    ``labels`` holds the rows to learn from (0 or 1, others and nulls are left
    out). Term weights are computed in tasks; 2 x bound x 8 KB are collected.
    """
    rows = labels.where(F.col(label_col).isin(0, 1))
    chosen = per_class(rows.join(docs.select(F.col(id_col)).distinct(), id_col, "left_semi"), id_col, label_col, bound)
    src = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
           .join(F.broadcast(chosen), "id").select("id", "text", F.col("class").cast("int").alias("label")))   # 2 x bound ids

    def run(batches):
        for b in batches:
            texts = texts_of(b, "text")
            for part in row_blocks(texts, max_rows=200):
                x = term_counts(texts[part])
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(part.start, len(x)).cast(pa.int64()), b.column("label").slice(part.start, len(x)),
                     pa.array([r.tobytes() for r in x], pa.binary())], ["id", "label", "x"])

    got = sorted(src.mapInArrow(tidied(run), "id bigint, label int, x binary").collect())
    x = np.array([np.frombuffer(r.x, np.float32) for r in got], np.float32).reshape(-1, TERMS)
    return Model(x, np.array([r.label for r in got], int))


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """(id, score double in 0..1, predicted int) for every input row; null text counts as empty.

    Only the text is read, whole. Without any labelled row every score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            texts = texts_of(b, "text")
            for part in row_blocks(texts):
                score = shared.value.score(texts[part])
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(part.start, len(score)), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    ["id", "score", "predicted"])

    id_type = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(tidied(run), f"id {id_type}, score double, predicted int").withColumnRenamed("id", id_col)


def filter_rows(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose text reaches the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            texts = texts_of(b, text_col)
            for part in row_blocks(texts):
                good = shared.value.score(texts[part]) >= threshold
                yield b.slice(part.start, len(good)).filter(pa.array(good))

    return docs.mapInArrow(tidied(run), docs.schema)
