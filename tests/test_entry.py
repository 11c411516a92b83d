"""Driver contract: entry, queries and their DuckDB oracles agree (sf0.001)."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb
import pytest
from conftest import SF001

import __spark_entry__ as E

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and df.columns == ["EVENT_TYPE", "INSERTED", "TOTAL_DATA_MB", "SUBSCRIBERS"]
    assert sum(r.INSERTED for r in rows) == 742


def test_every_query_has_an_oracle():
    from cdrflow.plans.registry import ORACLES, QUERIES

    assert set(ORACLES) == set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _own_names():
    from cdrflow.plans.registry import ORACLES

    return sorted(ORACLES)


@pytest.mark.parametrize("name", _own_names())
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    cols = df.columns
    got = sorted((tuple(_norm(x) for x in r) for r in df.collect()), key=repr)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert got == exp


def test_core_queries_stay_when_the_subpackage_cannot_be_imported(monkeypatch):
    """A package that it needs is missing, or its folder is gone: the other queries are all there."""
    import sys

    from cdrflow.plans.registry import ORACLES, QUERIES

    monkeypatch.setitem(sys.modules, "cdrflow.llm.queries", None)
    assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) == set(ORACLES)
    monkeypatch.undo()
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert "pipeline" not in E.queries()
