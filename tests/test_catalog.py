"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from botsieve.plans import catalog
from botsieve.sources.tables import TEST_TABLES
from conftest import SF0001

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


def norm(v):
    if isinstance(v, float) and not math.isnan(v) and v:
        return round(v, 9 - int(math.floor(math.log10(abs(v)))))
    if getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    return v


def sort_key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[:3] == ["window_start", "window_end", "ipAddress"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF0001)
    cols = df.columns
    got = sorted((tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect()), key=sort_key)
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in sorted(dcols)]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=sort_key)
    assert got == want
