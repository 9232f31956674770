"""Every query with a SQL twin gives the rows that DuckDB gives (all queries, also with input order and partitions changed)."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for t in TABLES:
        out.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return out


@pytest.mark.parametrize("name", [n for n in ORACLE if not n.startswith("op")])
def test_twin(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    found = con.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    want = sorted(repr(tuple(r[names.index(c)] for c in cols)) for r in found.fetchall())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
