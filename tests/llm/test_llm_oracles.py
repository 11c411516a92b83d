"""The SQL-expressible queries agree with DuckDB on sf0.001."""

import duckdb
import pytest
from conftest import SF001

from cdrflow.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = QUERIES[name](spark, SF001)
    got = sorted(map(tuple, df.collect()), key=repr)
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(c) for c in df.columns]
    assert got == sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=repr)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
