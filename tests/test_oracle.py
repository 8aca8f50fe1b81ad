"""Every registered query against its DuckDB oracle (sf0.001 here; the
driver and tools/check_oracle.py run sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E  # noqa: E402
from ledgerhawk.plans import oracle, registry  # noqa: E402
from conftest import SF0001
from tools.check_oracle import TABLES, digest

QUERIES = registry.build()
ORACLES = oracle.build()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF0001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 21  # rules 1-4 on 2024-01-15 at sf0.001: 5 + 9 + 7 + 0
