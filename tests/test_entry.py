"""Driver contract smoke tests."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 25 and df.columns == ["n", "rnk", "ngram", "cnt"]


def test_every_query_has_a_callable():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert all(callable(f) for f in qs.values())
