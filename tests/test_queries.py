"""Every query of the catalogue runs on the smallest tables; those with SQL give what DuckDB gives."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from quern.plans import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")


def canonical(rows: list[tuple]) -> list[tuple]:
    def value(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return ""
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(value(v) for v in r) for r in rows)


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in os.listdir(SF):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return connection


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query(spark, tables, name):
    df = catalogue.queries()[name](spark, SF)
    columns = sorted(df.columns)
    assert len(set(columns)) == len(columns)
    got = canonical([tuple(r[c] for c in columns) for r in df.collect()])
    sql = catalogue.oracle_sql().get(name)
    if sql:
        tables.execute(sql)
        names = [d[0] for d in tables.description]
        assert sorted(names) == columns
        assert got == canonical([tuple(r[names.index(c)] for c in columns) for r in tables.fetchall()])


def test_names_agree():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())


def test_core_does_not_need_the_llm_package():
    import re
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent / "quern"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"^\s*(?:from|import)\s+quern\.llm", path.read_text(), re.M), path
