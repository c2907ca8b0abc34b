"""Fitting and scoring of the classifiers against plain forms; samples; tables that go away."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry import session
from quarry.llm import language, quality_model, queries, samples
from quarry.llm.common import held_out
from quarry.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def sparse_of(x):
    rows = [np.flatnonzero(r) for r in x]
    return language.Sparse(np.concatenate(rows).astype(np.uint16), np.concatenate([r[i] for r, i in zip(x, rows, strict=True)]).astype(np.float32),
                           np.cumsum([len(i) for i in rows]))


def test_sparse_machine_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = np.zeros((60, language.DIM))
    x[:, :40] = rng.random((60, 40)) * (rng.random((60, 40)) < 0.5)
    y = np.where(x[:, 0] + x[:, 1] > x[:, 2] + x[:, 3], 1, -1)
    s, l2 = sparse_of(x), 0.01
    w = language.linear_svm(s, y, l2=l2, rounds=6000)
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    xb = np.c_[s.dot(np.eye(language.DIM)[:, 0])[:, None] * 0 + x, np.ones(60)]
    slack = np.maximum(0, 1 - y * (xb @ w))
    grad = l2 * w - 2 * xb.T @ (weight * slack * y)
    assert np.abs(grad).max() < 1e-4                    # the optimum of the stated objective
    assert np.allclose(s.dot(w[:-1]), x @ w[:-1], atol=1e-6) and np.allclose(s.dot_rows(slack), x.T @ slack, atol=1e-5)
    half = s.take(y > 0)
    assert np.allclose(half.dot(w[:-1]), (x @ w[:-1])[y > 0], atol=1e-6)


def plain_language(model, text):
    """One text at a time, gram by gram."""
    letters = [c if 97 <= c <= 122 or c >= 128 else 32 for c in text.decode().lower().encode()] + [32]
    padded = letters + [32] * 3
    sums = np.zeros(len(model.bias))
    half = language.DIM // 2
    shift = 32 - half.bit_length() + 1
    for i in range(len(letters)):
        three = padded[i] << 16 | padded[i + 1] << 8 | padded[i + 2]
        four = (three << 8 | padded[i + 3]) & 0xFFFFFFFF
        sums += model.weights[(three * 0x9E3779B1 & 0xFFFFFFFF) >> shift].astype(float)
        sums += model.weights[half + ((four * 0x85EBCA77 & 0xFFFFFFFF) >> shift)]
    margin = sums / len(letters) + model.bias
    n = len(model.families) if len(model.families) > 1 else 0
    e = np.exp(3 * margin[:n] - (3 * margin[:n]).max()) if n else np.ones(1)
    fam = int(e.argmax())
    votes = {c: 0.0 for c in range(len(model.langs)) if model.families.index(language.family_of(model.langs[c])) == fam}
    weakest = {c: 1.0 for c in votes}
    for k, (f, a, b) in enumerate(model.pairs):
        if f == fam:
            p = 1 / (1 + np.exp(-6 * margin[n + k]))
            votes[a] += (p >= 0.5) + 1e-3 * p
            votes[b] += (p < 0.5) + 1e-3 * (1 - p)
            weakest[a] *= max(p, 0.5)
            weakest[b] *= max(1 - p, 0.5)
    best = max(votes, key=votes.get)
    return model.langs[best], e[fam] / e.sum() * weakest[best]


def test_language_equals_gram_by_gram(spark):
    docs = read_table(spark, SF, "documents")
    model = language.fit(docs.where(~held_out("doc_id")))
    texts = {r.doc_id: (r.text or "").encode() for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in queries.op6_language(spark, SF).collect()}
    assert len(got) == len(texts)
    for i, text in sorted(texts.items())[:80]:
        want = plain_language(model, text) if language.has_letter(text) else ("und", 0.0)
        assert got[i].lang_pred == want[0] and got[i].score == pytest.approx(want[1], abs=1e-5)


def test_quality_equals_one_text_at_a_time(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    model = quality_model.fit(docs, labels.where(~held_out("doc_id")))
    got = {r.doc_id: r for r in queries.op10_quality_model(spark, SF).collect()}
    for r in docs.orderBy("doc_id").limit(60).collect():
        x = quality_model.term_counts([(r.text or "").encode()])[0].astype(np.float64) * model.idf
        z = x @ model.basis.astype(np.float64)
        z /= max(np.linalg.norm(z), 1e-12)
        cos = model.vectors.astype(np.float64) @ z
        near = np.argsort(-cos, kind="stable")[:quality_model.NEIGHBOURS]
        sim = np.clip(cos[near], 1e-3, 1) ** 8 * model.balance[near]
        want = float((sim * model.y[near]).sum() / sim.sum())
        assert got[r.doc_id].score == pytest.approx(want, abs=2e-3)      # a tie at the last neighbour may fall otherwise
        assert got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.7)


@pytest.mark.parametrize("partitions", [1, 40])
def test_samples_are_the_least_hashes(spark, partitions):
    rows = spark.range(30_000, numPartitions=partitions).select("id", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 1000 == 1, "b").otherwise("c").alias("class"))
    rows = rows.unionByName(rows.where("class = 'b'")).unionByName(spark.createDataFrame([(None, "a"), (1, None)], "id bigint, class string"))
    got = {}
    for r in samples.per_class(rows, "id", "class", 50).collect():
        got.setdefault(r["class"], set()).add(r.id)
    every = rows.dropna().distinct().withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1 << 40))).collect()
    for c in "abc":
        want = sorted((r.h, r.id) for r in every if r["class"] == c)[:50]
        assert got[c] == {i for _, i in want}


def test_no_table_is_left_behind(spark, tmp_path):
    import os
    session.remove_shared()
    queries.op7_minhash(spark, SF).count()
    assert session._SHARED
    paths = list(session._SHARED)
    session.remove_shared()
    assert not session._SHARED and not any(os.path.exists(p.removeprefix("file:")) for p in paths)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    assert session.is_local("local[8]") and session.is_local("local") and not session.is_local("local-cluster[2,1,1024]")

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
