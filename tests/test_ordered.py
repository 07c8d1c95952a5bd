"""Running sums, carried values and places against plain loops, on sparse orders and with one key that holds most rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quern.operators import layout, ordered


@pytest.fixture(autouse=True)
def small_ranges(spark):
    """Small partitions are not put together, so that there are several ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def frame(spark, seed=3):
    """Lines numbered as page * 100,000 + n; one document has two thirds of them, one key is null."""
    rng = random.Random(seed)
    rows = []
    for doc, pages in (("hot", 1_000), ("b", 200), (None, 100), ("c", 1)):
        for page in range(pages):
            rows += [(doc, page * 100_000 + n, rng.randint(0, 3), rng.choice([None, None, "x", "y"])) for n in range(6)]
    return rows, spark.createDataFrame(rows, "doc_id string, line_no bigint, v int, mark string").repartition(7)


def loops(rows):
    expected = {}
    for doc in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == doc), key=lambda r: r[1])
        total, last = 0, None
        for _, at, v, mark in mine:
            total += v
            expected[doc, at] = [total, last, mark or last, None]
            last = mark or last
        after = None
        for _, at, _, mark in reversed(mine):
            expected[doc, at][3] = after
            after = mark or after
    return expected


def test_along(spark):
    rows, df = frame(spark)
    ahead = ordered.along(df, ["doc_id"], "line_no", {"total": F.col("v")}, {"before": F.col("mark")}, current=False)
    upto = ordered.carried(df, {"upto": F.col("mark")}, ["doc_id"], "line_no")
    after = ordered.carried(df, {"after": F.col("mark")}, ["doc_id"], "line_no", forward=False, current=False)
    got = {(r.doc_id, r.line_no): [r.total, r.before] for r in ahead.collect()}
    for r in upto.collect():
        got[r.doc_id, r.line_no].append(r.upto)
    for r in after.collect():
        got[r.doc_id, r.line_no].append(r.after)
    assert got == loops(rows)


def test_ranges_hold_many_rows_however_sparse_the_order(spark):
    rows, df = frame(spark)
    ranged = ordered.ranged(df, ["doc_id"], "line_no")
    table = ranged.groupBy("doc_id", "_range").count().collect()
    # As many as there are partitions and keys, and none holds the hot key.
    assert len(table) <= 4 + 4 and max(r["count"] for r in table if r.doc_id == "hot") < 4_000
    assert len([r for r in table if r.doc_id == "hot"]) >= 2
    bounds = ranged.where("doc_id = 'hot'").groupBy("_range").agg(F.min("line_no").alias("a"), F.max("line_no").alias("b")).orderBy("_range").collect()
    assert all(x.b < y.a for x, y in zip(bounds, bounds[1:]))


def test_sections_of_a_hot_document(spark):
    """The ranges of all lines are fewer than a thousandth of them."""
    lines = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 3)).alias("doc_id"), (F.col("id") * 100_000).alias("line_no"), F.concat(F.when(F.col("id") % 50 < 3, F.lit("1.2 Head ")).otherwise(F.lit("plain words of a line, number ")), F.col("id").cast("string"), F.lit(" x")).alias("text"), F.col("id").cast("int").alias("page"), F.lit(10.0).alias("size"), F.lit(False).alias("bold"), F.lit(0.0).alias("y"))
    marked = layout.sectioned(lines)
    assert 3 < marked.select("doc_id", "_range").distinct().count() < 60
    assert marked.agg(F.max("section")).first()[0] == marked.where("level IS NOT NULL").groupBy("doc_id").count().agg(F.max("count")).first()[0]


def test_positions_and_first_rows(spark):
    rows, df = frame(spark)
    placed = ordered.positions(df, [F.col("v"), F.col("doc_id"), F.col("line_no")])
    expected = sorted(rows, key=lambda r: (r[2], (r[0] is not None, r[0] or ""), r[1]))
    assert [(r.doc_id, r.line_no) for r in placed.orderBy("position").collect()] == [(r[0], r[1]) for r in expected]
    assert [r.position for r in placed.orderBy("position").collect()] == list(range(1, len(rows) + 1))
    few = ordered.first_n(df, ["doc_id"], "line_no", 3).collect()
    assert sorted((r.doc_id or "", r.line_no) for r in few) == sorted((d or "", n) for d in ("hot", "b", None, "c") for n in range(3))


def test_empty(spark):
    df = spark.createDataFrame([], "k string, o bigint, v int")
    assert ordered.running_sum(df, "s", F.col("v"), ["k"], "o").count() == 0
    assert ordered.positions(df, [F.col("o")]).count() == 0
