"""The pipeline against its operators' brute-force counterparts, stage by stage."""

import __spark_entry__ as E
import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from test_brute_force import SF, brute_components, brute_repeats, sets_of

from quarry.llm import quality_rules
from quarry.sources.tables import read_table


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    kept = [r.asDict() for r in docs.collect()]
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = spark.createDataFrame(stage(spark, frame, SF).collect(), docs.schema)   # as if written and read again
        assert frame.columns == docs.columns
        now = {r.doc_id: r.asDict() for r in frame.collect()}
        before = {r["doc_id"]: r for r in kept}
        if name == "quality_classifier":
            quality = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
            known = [i for i in before if i in quality]
            assert np.mean([(i in now) == bool(quality[i]) for i in known]) >= 0.95
        elif name == "quality_rules":
            assert set(now) == {i for i, r in before.items() if not quality_rules.failed(quality_rules.measure((r["text"] or "").encode()))}
        elif name == "near_duplicates":
            comps = brute_components({i: sets_of(r["text"]) for i, r in before.items()})
            assert set(now) == {i for i in before if comps[i] == i}
        else:
            want = brute_repeats([(i, r["text"].encode()) for i, r in before.items()], 50)
            removed = {i: gone for i, _, gone, _, _ in want}
            assert set(now) == set(before)
            for i, r in now.items():
                lost = len(before[i]["text"].encode()) - len(r["text"].encode())
                assert removed[i] <= lost <= removed[i] + 6 * len(before[i]["text"]) * (removed[i] > 0)
                assert r["n_chars"] == len(r["text"])
                assert removed[i] or r["text"] == before[i]["text"]
        assert all(r["text"] == before[i]["text"] for i, r in now.items()) or name == "repeated_passages"
        kept = list(now.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect()
    assert {r.doc_id for r in pieces} == {r["doc_id"] for r in kept}


def test_run_and_registration(spark):
    assert E.queries()["pipeline"](spark, SF).count() > 0
    assert {q.split("_")[0] for q in E.queries() if q.startswith("op")} >= {f"op{n}" for n in range(1, 11)}


def test_stages_on_odd_rows(spark):
    rows = [(None, "words " * 3, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "a b", "en", "s", 3), (3, "a b", "en", "s", 3)]
    schema = read_table(spark, SF, "documents").schema
    for given in (rows, []):
        for _name, stage in corpus_pipeline.STAGES:
            got = stage(spark, spark.createDataFrame(given, schema), SF).collect()
            assert {r.doc_id for r in got} <= {r[0] for r in given} and (len(got) <= len(given) or _name == "packing")


def test_near_duplicates_judges_each_text_of_an_id(spark):
    a, b = "one two three four five six seven eight", "nine ten eleven twelve thirteen fourteen fifteen"
    rows = [(3, a), (5, a), (5, b), (5, b), (5, b.replace(" ", "  ")), (6, "x"), (6, "y"), (6, "y"), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], read_table(spark, SF, "documents").schema)
    for given in (docs, docs.orderBy(F.desc("text"), "doc_id"), docs.repartition(5)):
        got = corpus_pipeline.near_duplicates(spark, given, SF)
        kept = [(r.doc_id, " ".join(r.text.split())) for r in got.collect()]
        assert got.columns == docs.columns and sorted(kept, key=str) == sorted([(3, a), (5, b), (6, "x"), (6, "y"), (None, a)], key=str)
    whole = spark.createDataFrame(got.collect(), docs.schema)
    assert {(r.doc_id, r.text) for r in corpus_pipeline.repeated_passages(spark, whole, SF).collect()} == {(r.doc_id, r.text) for r in whole.collect()}
