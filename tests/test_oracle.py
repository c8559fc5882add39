"""Every query outside llm against DuckDB on the smallest tables."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb
import pytest

from marblework import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()
#: The single checks are rows of qs_checks.
NAMES = [n for n in QUERIES if not (n.startswith("qs_") and n[3:4] in "SCOL" and n[4:].isdigit())]


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for f in os.listdir(tiny):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{tiny}/{f}'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return float(v) if isinstance(v, int) and not isinstance(v, bool) else v if not hasattr(v, "isoformat") else v.isoformat()


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query(name, spark, duck, tiny):
    df = QUERIES[name](spark, tiny)
    got = df.collect()
    if name in SQL:
        want = duck.execute(SQL[name])
        names = [d[0] for d in want.description]
        assert sorted(df.columns) == sorted(names)
        assert rows(df.columns, got) == rows(names, want.fetchall())


def test_sql_for_all():
    assert set(QUERIES) == set(SQL)
