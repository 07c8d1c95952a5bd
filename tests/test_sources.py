"""Sources and sinks on files written here."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quern import schemas
from quern.operators import quality
from quern.sources import artifacts, manifest, records, sinks

DOC = {"doc_id": "SP-1", "title": "T", "revision": "", "pub_date": "2020", "tier": 1, "format": "pdf", "url": "https://a.example/x.pdf", "landing_page": None, "status": "final", "license": "pd", "notes": ""}
ROW = dict(id="SP-1/section/a", text="ü", doc_id="SP-1", doc_title="T", revision="", pub_date="2020", tier=1, chunk_type="section", control_id=None, section_path=None, source_url="", sha256_source="f")


def test_manifest(spark, tmp_path):
    path = tmp_path / "m.json"
    whole = {"manifest_version": 1, "dataset_name": "d", "maintainer": "m", "documents": [DOC, DOC | {"doc_id": "SP-2", "format": "pdf-manual", "url": None, "landing_page": "https://b.example"}]}
    path.write_text(json.dumps(whole, indent=1))
    assert [r.doc_id for r in manifest.read_manifest(spark, str(path)).orderBy("doc_id").collect()] == ["SP-1", "SP-2"]
    bad = {"documents": [{k: v for k, v in DOC.items() if k != "notes"}, DOC | {"tier": 3, "format": "doc", "url": "http://a"}, DOC | {"doc_id": "SP-3", "url": None}, DOC | {"doc_id": "SP-4", "format": "pdf-manual"}]}
    path.write_text(json.dumps(bad))
    with pytest.raises(ValueError) as error:
        manifest.read_manifest(spark, str(path))
    for part in ("missing maintainer", "missing field notes", "duplicate doc_id", "format doc is unknown", "tier must be", "url must be https", "SP-3: format pdf requires a url", "SP-4: format pdf-manual requires a landing_page"):
        assert part in str(error.value)
    path.write_text("{}")
    with pytest.raises(ValueError, match="non-empty list"):
        manifest.read_manifest(spark, str(path))


def test_provenance(spark, tmp_path):
    assert artifacts.read_provenance(spark, str(tmp_path / "none.json")).count() == 0
    entry = {"sha256": "ab", "bytes": 5, "retrieved_at": "2020-01-01", "url": "u", "http_status": 200, "source": "download", "skipped": False, "note": ""}
    path = tmp_path / "p.json"
    path.write_text(json.dumps({"B": entry, "A": entry | {"sha256": None, "skipped": True}}))
    read = artifacts.read_provenance(spark, str(path))
    assert list(json.loads(sinks.provenance_json(read))) == ["A", "B"] and json.loads(sinks.provenance_json(read))["B"] == entry


@pytest.mark.parametrize(
    "content,format_,url,fine",
    [
        (b"  %PDF-1.7", "pdf", None, True), (b"<html>", "pdf", None, False), (b'{"catalog": {}}', "oscal", None, True), (b'{"profile": {}}', "oscal", None, True), (b'{"other": 1}', "oscal", None, False), (b"[1]", "oscal", None, False), (b"{", "oscal", None, False), (b"\xff\xfe", "oscal", None, False),
        (b"[1]", "web", "https://a/x.json", True), (b"[]", "web", "https://a/x.json", False), (b"<!DOCTYPE HTML><p>", "web", "https://a", True), (b"plain", "web", "https://a", False), (b"", "pdf-manual", None, False),
    ],
)
def test_sanity(spark, content, format_, url, fine):
    df = spark.createDataFrame([(content, format_, url)], "c binary, f string, u string")
    assert (df.select(artifacts.sanity_problem(F.col("c"), F.col("f"), F.col("u")).alias("p")).first().p is None) is fine


def test_files_and_actions(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.pdf").write_bytes(b"%PDF")
    file = artifacts.read_artifacts(spark, str(tmp_path / "raw")).first()
    assert file.bytes == 4 and len(file.sha256) == 64
    docs = spark.createDataFrame([("a", "pdf"), ("b", "pdf"), ("c", "web"), ("d", "embedded-in-oscal"), ("e", "pdf-manual"), ("f", "pdf-manual")], "doc_id string, format string").withColumn("landing_page", F.lit("l"))
    recorded = spark.createDataFrame([("a", "1", "t0"), ("b", "2", "t0"), ("e", "5", "t0")], "doc_id string, sha256 string, retrieved_at string")
    disk = spark.createDataFrame([("a", "1", 4), ("b", "9", 4), ("e", "5", 4)], "doc_id string, sha256 string, bytes bigint")
    actions = {r.doc_id: r.action for r in artifacts.fetch_actions(docs, recorded, disk).collect()}
    assert actions == {"a": "cached", "b": "download", "c": "skipped", "d": "skipped", "e": "manual", "f": "manual-missing"}
    assert {r.doc_id: r.action for r in artifacts.fetch_actions(docs, recorded, disk, include_web=True, force=True).collect()}["c"] == "download"
    manual = {r.doc_id: r for r in artifacts.manual_record(docs, recorded, disk, "t9").collect()}
    assert manual["e"].retrieved_at == "t0" and manual["f"].skipped and manual["f"].note == "awaiting manual placement"


def test_strict_rows(spark):
    good = json.dumps(ROW)
    payloads = [good, good[:-4], json.dumps(ROW | {"extra": 1}), json.dumps({k: v for k, v in ROW.items() if k != "tier"}), None, "[]", ""]
    df = spark.createDataFrame([(p,) for p in payloads], "payload string")
    problems = [r.problem for r in records.decoded(df).collect()]
    assert problems[0] is None and "unknown fields: extra" in problems[2] and "missing fields: tier" in problems[3] and all(problems[1:])
    assert records.strict_rows(df.limit(1)).first().asDict() == ROW
    # Which of the bad rows is met first depends on which task is faster.
    with pytest.raises(Exception, match="not a complete JSON object|missing fields|unknown fields"):
        records.strict_rows(df).collect()


def test_jsonl_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([tuple((ROW | {"id": f"SP-1/section/{k}"}).values()) for k in range(5)], schemas.ROW)
    sinks.write_jsonl(rows.coalesce(1), str(tmp_path / "out"))
    (written,) = (tmp_path / "out").glob("*.json")
    assert json.loads(written.read_text().splitlines()[0])["control_id"] is None
    folder = tmp_path / "interim"
    folder.mkdir()
    (folder / "b.rows.jsonl").write_text(written.read_text())
    (folder / "chunked.rows.jsonl").write_text(written.read_text())
    (folder / "b.rejections.jsonl").write_text('{"doc_id":"D","ref":"r","rule":"x","detail":"","stage":"s"}\n')
    read = records.read_interim(spark, str(folder)).orderBy("line_no").collect()
    assert [r.line_no for r in read] == [1, 2, 3, 4, 5] and [json.loads(r.payload)["id"][-1] for r in read] == list("01234")
    assert records.read_rejections(spark, str(folder)).first().rule == "x"


def test_parquet(spark, tmp_path):
    rows = spark.createDataFrame([tuple((ROW | {"id": i, "doc_id": d, "control_id": c}).values()) for i, d, c in (("3", "B", None), ("2", "A", "ac-11"), ("1", "A", "ac-2"), ("0", "A", None))], schemas.ROW)
    sinks.write_parquet(rows, str(tmp_path / "p"), files=1)
    assert [r.id for r in spark.read.parquet(str(tmp_path / "p")).collect()] == ["0", "1", "2", "3"]
    broken = spark.createDataFrame([(None, *list(ROW.values())[1:])], schemas.ROW.simpleString()[7:-1].replace(":", " "))
    with pytest.raises(Exception, match="id is null"):
        sinks.write_parquet(broken, str(tmp_path / "q"))


def test_playbook(spark):
    long = "Guidance text. " * 20
    made = [("GOVERN 1.1", "d", long), ("GOVERN 1.1", "again", long), ("", "d", long), ("MAP 1.1", "d", ""), (None, None, None)]
    df = spark.createDataFrame([("PB", k, "Govern", t, d, a, None, None, None) for k, (t, d, a) in enumerate(made)], "doc_id string, place bigint, type string, title string, description string, section_about string, section_actions string, section_doc string, section_ref string")
    rows, rejected = records.playbook(df)
    (row,) = rows.collect()
    assert row.id == "PB/ai_rmf_subcategory/govern-1.1" and row.section_path == "AI RMF Playbook > Govern > GOVERN 1.1" and row.text.startswith("GOVERN 1.1: d\n\nAbout:\nGuidance")
    assert sorted((r.ref, r.rule) for r in rejected.collect()) == [("GOVERN 1.1", "duplicate_subcategory"), ("MAP 1.1", "playbook_entry_too_short"), ("record[2]", "missing_title"), ("record[4]", "missing_title")]


def test_json_files(spark, tmp_path):
    (tmp_path / "pb.json").write_text(json.dumps([{"title": "A", "type": "Map"}, {"title": "B", "other": 1}], indent=1))
    assert [(r.doc_id, r.place, r.title, r.type) for r in records.read_playbook(spark, str(tmp_path / "pb.json"), "PB").orderBy("place").collect()] == [("PB", 0, "A", "Map"), ("PB", 1, "B", None)]
    (tmp_path / "CAT-1.json").write_text('{"catalog": {}}')
    assert sorted(r.doc_id for r in records.read_catalogs(spark, str(tmp_path)).collect()) == ["CAT-1", "pb"]


def test_samples(spark):
    df = spark.createDataFrame([("a" if k % 3 else "b", k) for k in range(100)], "t string, o bigint")
    assert sorted((r.t, r.o) for r in quality.samples(df, "t", "o", 2).collect()) == [("a", 1), ("a", 2), ("b", 0), ("b", 3)]


def test_quality(spark):
    rows = spark.createDataFrame([tuple((ROW | {"id": f"{k}", "text": "x" * n, "chunk_type": t, "control_id": c}).values()) for k, (n, t, c) in enumerate([(10, "section", None), (300, "section", None), (250, "section", None), (9000, "section", None), (90, "control", "ac-1"), (90, "control_enhancement", "ac-1.1"), (90, "ai_rmf_subcategory", None)])], schemas.ROW)
    stats = {r.chunk_type: r for r in quality.length_stats(rows).collect()}
    assert (stats["section"].upper_median, stats["section"].under, stats["section"].over) == (300, 1, 1)
    warned = {(r.check, r.subject): r.value for r in quality.expected_counts(rows).where("warning").collect()}
    assert warned == {("control_rows", ""): 2, ("families", ""): 1, ("ssdf_practices", ""): 0, ("ai_rmf_subcategories", "SP-1"): 1}
    assert quality.sorted_controls(rows, "control_id").first().controls == "AC-1, AC-1(1)"
    rejections = spark.createDataFrame([("D", "r", "x", "", "chunk")], schemas.REJECTION)
    text = quality.summary_markdown(rows, rejections, quality.expected_counts(rows))
    assert "Rows published: **7**" in text and "| chunk | `x` | 1 |" in text and "control_rows" in text
    report = sinks.verification_report(spark.createDataFrame([tuple(DOC.values())], schemas.DOCUMENT), spark.createDataFrame([("SP-1", 404, "gone")], "doc_id string, status int, note string"))
    assert "| `SP-1` | T | pdf | 404 | gone |" in report
