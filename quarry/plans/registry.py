"""All registered queries and SQL oracles, merged from the subject modules."""

from __future__ import annotations

from quarry.plans import ml_oracle, ml_queries, series_oracle, series_queries, text_oracle, text_queries


def queries() -> dict:
    out = {}
    out.update(text_queries.QUERIES)
    out.update(series_queries.QUERIES)
    out.update(ml_queries.QUERIES)
    return out


def oracle_sql() -> dict:
    out = {}
    out.update(text_oracle.ORACLE)
    out.update(series_oracle.ORACLE)
    out.update(ml_oracle.ORACLE)
    return out
