"""Every query of the llm package runs on the smallest tables; those with SQL give what DuckDB gives."""

from __future__ import annotations

import os

import duckdb
import pytest

from quern.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in os.listdir(SF):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, tables, name):
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in columns) for r in df.collect())
    tables.execute(queries.oracle_sql()[name])
    names = [d[0] for d in tables.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(str(r[names.index(c)]) for c in columns) for r in tables.fetchall())


def test_shares_are_met(spark):
    """Every source with documents has its share, but for a token; none is used more often than it may be."""
    rows = queries.p7_shares(spark, SF).collect()
    total = sum(r.mixture_tokens for r in rows)
    assert total > 0
    for r in rows:
        assert abs(r.mixture_tokens - total * r.reachable_share) <= 1 + len(rows) and r.mixture_tokens <= r.available_tokens * r.max_repeats


def test_mixture_holds_what_the_report_says(spark):
    mixed = queries.p7_mixture(spark, SF)
    counted = {r.source: r.n for r in mixed.groupBy("source").agg({"tokens": "sum"}).withColumnRenamed("sum(tokens)", "n").collect()}
    assert counted == {r.source: r.mixture_tokens for r in queries.p7_shares(spark, SF).collect() if r.mixture_tokens}
