"""Every registered query against its DuckDB oracle on the smallest tables."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tessera.plans import registry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
ORACLES = E.oracle_sql()
E.queries()
NAMES = sorted(registry.QUERIES)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["trips", "points"] and len(rows) == 1


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLES, "every query of the layer engine has an oracle"
    df = E.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    cur = con.execute(ORACLES[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(ocols)
    a = sorted((tuple(_norm(r[df.columns.index(c)]) for c in order) for r in rows), key=repr)
    b = sorted((tuple(_norm(r[ocols.index(c)]) for c in order) for r in orows), key=repr)
    assert a == b
