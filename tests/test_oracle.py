"""Every registered query against its DuckDB oracle at sf0.001 (values by repr).

The same comparison as tools/check_oracle.py --raw; the driver's gate runs it
at sf0.01.  Rows-only queries must run and keep their schema.
"""

import duckdb
import pytest

import __spark_entry__ as entry
from recoengine.plans.queries import QUERIES as OWN
from recoengine.plans.roles import TABLES

SF = "/root/testdata/sf0.001"
# the queries of the llm subpackage are tested in tests/llm
QUERIES = {k: v for k, v in entry.queries().items() if k in OWN}
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(r[i]) for i in order) for r in rows))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert df.columns and got is not None
        return
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, exp)
