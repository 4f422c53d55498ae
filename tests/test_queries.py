"""Every registered query against its DuckDB oracle on the smallest test tables.

The driver runs the same comparison at sf0.01; this keeps it in the suite.
Queries without an oracle are compared with brute force in their own tests;
here they are only executed, and must give rows.
"""

import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _norm(v):
    # floats compare bit for bit (repr), as a value hash would; -0.0 != 0.0
    return repr(v) if isinstance(v, float) else v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return ([cols[i] for i in order],
            sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "score_vlc" in df.columns


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert s_rows
        return
    cur = duck.execute(sql)
    d_cols, d_rows = _canon([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_every_reference_query_has_an_oracle():
    from indicata.plans import catalog
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
