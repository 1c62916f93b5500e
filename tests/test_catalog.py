"""Every query with SQL against DuckDB; the others yield rows with a stable schema."""

from __future__ import annotations

import math

import duckdb
import pytest

from ionloom.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events".split()
SLOW = {"similarity_network", "protonated_network", "prune_components", "similarity_network_whole", "pagerank"}


@pytest.fixture(scope="module")
def oracle(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{small}/{t}.parquet')")
    return con


def _text(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else str(int(v)) if v == int(v) else repr(v)
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - SLOW))
def test_query(spark, oracle, small, name):
    df = catalog.queries()[name](spark, small)
    columns = sorted(df.columns)
    rows = sorted(tuple(_text(r[c]) for c in columns) for r in df.collect())
    if name not in catalog.oracle_sql():
        assert rows
        return
    found = oracle.execute(catalog.oracle_sql()[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == sorted(tuple(_text(r[k]) for k in order) for r in found.fetchall())
