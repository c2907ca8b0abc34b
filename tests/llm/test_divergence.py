"""The pointer sort against plain counting, and the audit against exact brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quarry.llm import divergence

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, n int, value string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def audit_by_hand(rows, min_docs, top):
    count, seen, occurring = Counter(), defaultdict(Counter), {(r[2] or "", r[3] or "") for r in rows}
    for _, text, lang, source in rows:
        lang, source, words = lang or "", source or "", terms_of(text)
        for w in words:
            count[lang, source, w] += 1
        seen[lang].update(set(words))
    out = []
    for lang in {a for a, _ in occurring}:
        kept = [t for t, n in seen[lang].items() if n >= min_docs]
        sources = sorted(b for a, b in occurring if a == lang)

        def ps(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}
        p = {s: ps({t: count[lang, s, t] for t in kept}) for s in sources}
        q = ps({t: sum(count[lang, s, t] for s in sources) for t in kept})
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            words = [(p[s][t] - q[t], t) for t in kept if count[lang, s, t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", words, top)):
                order = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(order, 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def random_rows(seed, n=150):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abÉéßZ\U0001f600") for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 17, 70, 130]))) for _ in range(30)]
    words += ["a" * k for k in (7, 8, 9, 63, 64, 65, 71, 72, 73, 200)] + ["a" * 71 + "b", "the", "The"]
    gaps = [" ", "\n", "1", "--", "\x7f", "@", "[", "`", "{"]
    return [(i, "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 40)))[:-rng.randint(1, 2) or None],
             rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s1", "s1", "s2", "é", None])) for i in range(n)]


def test_pointer_sort_counts_words():
    for seed in range(20):
        rows = random_rows(seed, 25)
        raw = [(r[1] or "").encode() for r in rows]
        starts = np.cumsum([0, *map(len, raw)])[:-1]
        group = np.array([seed * k % 3 for k in range(len(rows))])
        own, terms, n, docs = divergence.run_counts(np.frombuffer(b"".join(raw), np.uint8), starts, group)
        want, want_docs = Counter(), Counter()
        for r, g in zip(rows, group.tolist(), strict=True):
            want.update((g, t) for t in terms_of(r[1]))
            want_docs.update((g, t) for t in set(terms_of(r[1])))
        got = list(zip(own.tolist(), terms.to_pylist(), strict=True))
        assert dict(zip(got, n.tolist(), strict=True)) == want and len(got) == len(want)
        assert dict(zip(got, docs.tolist(), strict=True)) == want_docs
        assert got == sorted(got, key=lambda x: (x[0], x[1].encode()))


@pytest.mark.parametrize(("cells", "bucket", "slice_bytes"), [(divergence.CELLS, divergence.BUCKET_ROWS, divergence.SLICE_BYTES), (5, 20, 300)])
def test_against_brute_force(spark, monkeypatch, cells, bucket, slice_bytes):
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(divergence, "SLICE_BYTES", slice_bytes)
    rows = random_rows(99)
    got = sorted(tuple(r) for r in divergence.audit(table(spark, rows), min_docs=6, top=4).collect())
    assert got == audit_by_hand(rows, 6, 4) and len(got) > 60


def test_small_cases(spark):
    same = [(1, "one two one", "en", "a"), (1, "one two one", "en", "a"), (2, "one", "en", "b"), (3, "", "en", "c"), (4, None, None, None),
            (5, "x" * 300_000, "en", "a"), (None, "TWO", "en", None), (6, "x" * 300_000, "en", "b"), (7, "one", "", "lone")]
    got = sorted(tuple(r) for r in divergence.audit(table(spark, same), min_docs=2).collect())
    assert got == audit_by_hand(same, 2, 50) and {r[3] for r in got if r[2] == "term"} >= {"one", "two", "x" * 300_000}
    # no kept term: all pairs are listed with 0
    assert sorted(tuple(r) for r in divergence.audit(table(spark, same), min_docs=99).collect()) == audit_by_hand(same, 99, 50)
    assert divergence.audit(table(spark, [])).collect() == []


def test_probabilities_beyond_64_bits(spark):
    row = spark.sql("SELECT 9000000000000000 AS n, 9000000000000001L AS total, 3L AS kept") \
        .select(divergence.probability("n", "total", "kept", 10 ** 9, 5)).first()
    assert row[0] == 1 + 10 ** 9 * (9 * 10 ** 15 + 5) // (9 * 10 ** 15 + 1 + 15)
