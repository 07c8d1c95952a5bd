"""Queries of laid-out documents on ids that no int holds, as in larger tables, against their SQL."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from quern.plans import layouts
from test_queries import SF, canonical

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")


@pytest.fixture(scope="module")
def large_ids(spark, tmp_path_factory):
    """The smallest tables, their documents repeated with ids above 2^31."""
    folder = tmp_path_factory.mktemp("large_ids")
    for name in os.listdir(SF):
        if name != "documents.parquet":
            (folder / name).symlink_to(f"{SF}/{name}")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 3_000_000_000)).write.parquet(str(folder / "documents.parquet"))
    return str(folder)


def widened(sql: str) -> str:
    """The SQL with pages as wide as the ids that they are: it casts them to INT, which fails in DuckDB too, and has a
    billion for no cutoff."""
    return sql.replace("doc_id::INT AS page", "doc_id AS page").replace("pg::INT AS page", "pg AS page").replace("coalesce(cutoff, 1e9)", "coalesce(cutoff, 1e18)")


@pytest.mark.parametrize("name", ["content_lines", "publication_rejections", "sections", "treated_rows", "contents", "publication_rows", "span_lines", "longest_blocks", "repeating_lines", "treated_rejections"])
def test_ids_above_int(spark, large_ids, name):
    df = layouts.QUERIES[name](spark, large_ids)
    columns = sorted(df.columns)
    got = canonical([tuple(r[c] for c in columns) for r in df.collect()])
    connection = duckdb.connect()
    for table in os.listdir(large_ids):
        connection.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM '{large_ids}/{table}{'/*.parquet' if table == 'documents.parquet' else ''}'")
    connection.execute(widened(layouts.ORACLES[name]))
    names = [d[0] for d in connection.description]
    assert got == canonical([tuple(r[names.index(c)] for c in columns) for r in connection.fetchall()])
