"""Driver contract: entry() runs, every oracle key is a query, a sample of oracles agrees."""
import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF001

TABLES = ["lineitem", "orders", "events", "labels", "documents", "pages", "benchmark", "conversations", "embeddings"]


def test_entry_returns_metrics(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["n_clean"] == 395
    assert 0.0 <= rows[0]["auc"] <= 1.0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_agrees_at_sf0001(spark, con, name):
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = sorted(tuple(r[cols.index(c)] for c in sorted(cols)) for r in res.fetchall())
    df = E.queries()[name](spark, SF001)
    assert sorted(df.columns) == sorted(cols)
    got = sorted(tuple(r[c] for c in sorted(cols)) for r in df.collect())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            if isinstance(a, float) and b is not None:
                assert a == pytest.approx(float(b), abs=2e-6)
            else:
                assert a == b
