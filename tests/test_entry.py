"""Driver contract: entry(), queries() and oracle_sql() on the smallest scale factor."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "huawei_2g_cell_unique_id" in df.columns


# The training-data queries have tests of their own (tests/llm).
REPORT_QUERIES = sorted(set(E.queries()) - set(E.LLM_QUERIES))


def test_every_query_has_an_oracle():
    assert set(REPORT_QUERIES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    import datetime as dt
    import decimal
    if v is None:
        return "\0"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return str(v)


@pytest.mark.parametrize("name", REPORT_QUERIES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = sorted("|".join(_norm(r[c]) for c in sorted(df.columns)) for r in df.collect())
    res = duck.execute(E.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted("|".join(_norm(r[i]) for i in order) for r in res.fetchall())
    assert got == want
