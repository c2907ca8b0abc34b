"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and keeps its measurements
and one bit per failed rule. ``apply_policy`` and ``ablations`` work on the
ledger alone: a policy version is a bitmask, a verdict is one AND, and what a
rule contributes follows from a histogram of the masked bits.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import texts_of, tidied

#: Words are maximal runs of other characters than these.
WHITE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5

_CONTINUATION = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_HIGH = bytes(range(0x80, 0x100))
_ALL = bytes(range(256))
_NOT_LETTER = bytes(c for c in _ALL if c not in WHITE + _UPPER + _LOWER + _HIGH)
_NOT_ASCII_LETTER = bytes(c for c in _ALL if c not in WHITE + _UPPER + _LOWER)
_NOT_LOWER = bytes(c for c in _ALL if c not in WHITE + _LOWER)

class Measures(NamedTuple):
    """What is counted in a text."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int
    n_letter_words: int
    n_upper_words: int
    n_exclaims: int


#: Bit i belongs to the i-th rule: (name, whether the measures fail it).
RULES = (
    ("few_words", lambda m: m.n_words < 10),
    ("repeated_words", lambda m: 100 * m.n_repeat_words > 20 * m.n_words),
    ("symbols", lambda m: 100 * m.n_symbols > 15 * m.n_words),
    ("upper_case", lambda m: 100 * m.n_upper_words > 40 * m.n_words),
    ("exclamations", lambda m: 100 * m.n_exclaims > 30 * m.n_words),
    ("few_letters", lambda m: 100 * m.n_letter_words < 60 * m.n_words),
    ("duplicate_lines", lambda m: m.n_lines >= 4 and 100 * m.n_dup_lines > 50 * m.n_lines),
    ("word_length", lambda m: m.word_chars < 2 * m.n_words or m.word_chars > 40 * m.n_words),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = ("few_words", "repeated_words")

#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": BASE,
    "2024-symbols": (*BASE, "symbols", "few_letters"),
    "2025-full": tuple(BIT),
}
DEFAULT_POLICY = "2025-full"


def policy_mask(version: str) -> int:
    return sum(BIT[name] for name in POLICIES[version])


def repeat_words(words: list[bytes], n: int = WINDOW) -> int:
    """Words inside an n-word window that occurs at least twice in the list."""
    grams = list(zip(*(words[i:] for i in range(n)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    counts = Counter(grams)
    total = end = 0
    for i, g in enumerate(grams):
        if counts[g] > 1:
            total += i + n - max(i, end)
            end = i + n
    return total


def measure(text: bytes) -> Measures:
    words = text.split()   # on the six characters of WHITE
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = len(text.translate(None, _NOT_LETTER).split())
    upper = len(text.translate(None, _NOT_ASCII_LETTER).split()) - len(text.translate(None, _NOT_LOWER).split())
    return Measures(
            len(words), len(text.translate(None, WHITE + _CONTINUATION)),
            sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeat_words(words),
            len(lines), letters, upper, text.count(b"!"))


def failed(m: Measures) -> int:
    """The bits of the failed rules."""
    return sum(BIT[name] for name, fails in RULES if fails(m))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, the measures (bigint) and ``failed_bits`` (bigint).

    Null and empty texts have no words and fail ``few_words``. Texts are read
    whole; memory is bounded by an Arrow batch and the words of one text.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            rows = [(*m, failed(m)) for m in map(measure, texts_of(b, "text"))]
            cols = list(zip(*rows, strict=True)) or [[]] * (len(Measures._fields) + 1)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *(pa.array(c, pa.int64()) for c in cols)], ["id", *Measures._fields, "failed_bits"])

    id_type = src.schema["id"].dataType.simpleString()
    names = (*Measures._fields, "failed_bits")
    return src.mapInArrow(tidied(run), f"id {id_type}, " + ", ".join(f"{m} bigint" for m in names)).withColumnRenamed("id", id_col)


def apply_policy(led: DataFrame, version: str = DEFAULT_POLICY) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy version has failed."""
    return led.withColumn("kept", F.col("failed_bits").bitwiseAND(F.lit(policy_mask(version))) == 0)


def ablations(led: DataFrame, version: str = DEFAULT_POLICY) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that only it rejects.

    (rule string, n_failed bigint, n_only bigint): ``n_only`` documents would
    be kept without the rule. The ledger is reduced to a histogram of masked
    bits first (at most 2^rules rows, combined map-side).
    """
    spark = led.sparkSession
    mask = policy_mask(version)
    hist = (led.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask)).alias("bits"))
            .agg(F.count(F.lit(1)).alias("n")))
    rules = spark.createDataFrame([(r, BIT[r]) for r in POLICIES[version]], "rule string, bit bigint")
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("bigint").alias("bit")) for r in POLICIES[version])))
    counts = (hist.select("bits", "n", each.alias("r")).where(F.col("bits").bitwiseAND(F.col("r.bit")) != 0)
              .groupBy("r.rule").agg(F.sum("n").alias("n_failed"), F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n"))).alias("n_only")))
    return rules.join(counts, "rule", "left").select("rule", *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_failed", "n_only")))


def filter_rows(docs: DataFrame, text_col: str = "text", version: str = DEFAULT_POLICY) -> DataFrame:
    """The rows, with all their columns, that a policy version keeps."""
    mask = policy_mask(version)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array([not failed(measure(t)) & mask for t in texts_of(b, text_col)], pa.bool_()))

    return docs.mapInArrow(tidied(run), docs.schema)
