"""The n-gram job against a direct Python model of the reference's steps.

The model follows the book job literally on the sf0.001 documents: split
paragraphs at CRLF CRLF, sentences at ". ", lower-case and keep ASCII word
runs, split at [^0-9a-z], slide windows of n words, count.
"""

import collections
import os
import re

import duckdb
import pytest

from quarry.operators import ngrams as NG
from quarry.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def model_counts(texts, n):
    c = collections.Counter()
    for text in texts:
        for para in text.split("\r\n\r\n"):
            for sent in para.split(". "):
                norm = " ".join(re.findall(r"\w+", sent.lower(), flags=re.ASCII))
                words = re.split(r"[^0-9a-z]", norm)
                for i in range(len(words) - n + 1):
                    c[" ".join(words[i:i + n])] += 1
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_ngram_counts_equal_python_model(spark):
    texts = [r[0] for r in duckdb.connect().execute(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()]
    counts = NG.ngram_counts(NG.corpus_sentences(read_table(spark, SF, "documents")), (1, 2, 3)).collect()
    got = {n: {} for n in (1, 2, 3)}
    for r in counts:
        got[r.n][r.ngram] = r.cnt
    for n in (1, 2, 3):
        assert got[n] == dict(model_counts(texts, n))
