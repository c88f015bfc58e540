"""Every query that has SQL against DuckDB on the smallest tables; the others run."""

from __future__ import annotations

import decimal
from pathlib import Path

import duckdb
import pytest
from cliploom.plans.catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float | decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, list | tuple):
        return str([plain(x) for x in v])
    return str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    if name in ORACLES:
        found = duck.execute(ORACLES[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert got == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())
    else:
        assert got
