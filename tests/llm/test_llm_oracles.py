"""Training-data queries that SQL can express, against DuckDB."""
import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tessera.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in "documents pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(Q.ORACLES[name])
    cols = sorted(d[0] for d in cur.description)
    at = [[d[0] for d in cur.description].index(c) for c in cols]
    assert sorted(df.columns) == cols
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=repr)
