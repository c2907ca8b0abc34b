"""Helpers shared by the operators: Arrow columns, byte blocks, 64-bit mixing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import written_table

#: Text handled at once inside a task; a longer single text is a block of its own.
BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 500

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def byte_codes(seed: int) -> np.ndarray:
    """A random 64-bit code per byte value, the same in every task."""
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in batch.column(name).cast(pa.large_binary()).to_pylist()]


def row_blocks(texts: list[bytes], max_bytes: int = BLOCK_BYTES, max_rows: int = BLOCK_ROWS) -> Iterator[slice]:
    """Consecutive slices of bounded size that together cover all rows."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and (size + len(t) > max_bytes or i - start >= max_rows):
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def joined(texts: list[bytes], sep: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """One byte array with a separator after each text, and the text offsets (n + 1)."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts)) + len(sep)
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lens, out=off[1:])
    return np.frombuffer(sep.join(texts) + sep, np.uint8) if texts else np.zeros(0, np.uint8), off


def held_out(id_col: str):
    """True where crc32 of the id as text leaves remainder 2 modulo 4."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table written to the shared folder and read back.

    A table is written once, where ``checkpoint()`` computes the last stage
    twice (once to count it, once to write it), and readers prune its columns.
    The tables go with ``quarry.session.remove_shared`` or with the application.
    """
    return written_table(df)


def tidy() -> None:
    """Give freed memory back to the system: a Python worker lives on beside the next tasks."""
    with contextlib.suppress(OSError, AttributeError):   # not the GNU library
        ctypes.CDLL(None).malloc_trim(0)


def tidied(run):
    """The function of a mapInArrow task, tidying up behind its last batch."""
    def wrapped(batches):
        yield from run(batches)
        tidy()
    return wrapped


def tidied_group(run):
    """The function of an applyInArrow group, tidying up behind it."""
    def grouped(table):
        out = run(table)
        tidy()
        return out

    def cogrouped(table, other):
        out = run(table, other)
        tidy()
        return out
    return cogrouped if run.__code__.co_argcount == 2 else grouped


def release(spark: SparkSession) -> None:
    """Collect garbage on the driver between rounds of jobs.

    Spark's cleaner drops shuffles, broadcasts and checkpoints of earlier
    rounds only once the driver has collected the objects that stand for them.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
