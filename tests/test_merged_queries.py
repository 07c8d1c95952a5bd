"""The queries of short sections read whole texts, not their first lines."""

from __future__ import annotations

from quern.plans import build

LONG = "Heading\n" + "The steward reviews the schedule. " * 10


def _chunks(spark, folder) -> str:
    rows = [
        (1, "A", "a1", "section", LONG),
        (2, "A", "a2", "section", "Stub\nwith a second line"),
        (3, "A", "a3", "section", LONG),
        (4, "A", "a4", "section", "Tail\nof two lines"),
        (5, "B", "b1", "section", LONG),
        (6, "B", "b2", "section", "Stub\nbefore a control"),
        (7, "B", "b3", "control", LONG),
    ]
    spark.createDataFrame(rows, "row_no bigint, doc_id string, id string, chunk_type string, text string").write.parquet(f"{folder}/chunks.parquet")
    return str(folder)


def test_short_sections_are_judged_and_folded_whole(spark, tmp_path):
    folder = _chunks(spark, tmp_path)
    merged = {r.row_no: r.text for r in build.merged_sections(spark, folder).collect()}
    assert merged == {1: LONG, 3: "Stub\nwith a second line\n\n" + LONG.strip(), 5: LONG, 7: LONG}
    assert {(r.doc_id, r.ref) for r in build.trailing_stubs(spark, folder).collect()} == {("A", "a4"), ("B", "b2")}
