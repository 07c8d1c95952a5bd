"""Fetching with a transport of our own, PDF lines, and the stages of a build from files to files."""

from __future__ import annotations

import json

import pytest

from quern import schemas
from quern.__main__ import main
from quern.sources import fetch, pdf

DOC = {"doc_id": "SP-1", "title": "T", "revision": "", "pub_date": "2020", "tier": 1, "format": "pdf", "url": "https://a.example/x.pdf", "landing_page": None, "status": "final", "license": "pd", "notes": ""}


class Web:
    """Answers by url: a list is worked off, a value stays."""

    def __init__(self, answers):
        self.answers, self.asked, self.slept, self.now = answers, [], [], 0.0

    def client(self):
        def transport(method, url, headers, timeout):
            self.asked.append((method, url))
            answer = self.answers[url]
            answer = answer.pop(0) if isinstance(answer, list) else answer
            if isinstance(answer, Exception):
                raise answer
            return answer[0], {}, answer[1] if method == "GET" else b""

        def sleep(seconds):
            self.slept.append(round(seconds, 3))
            self.now += seconds

        return fetch.Client(transport, clock=lambda: self.now, sleep=sleep)


def test_download_tries_again():
    web = Web({"https://a/x": [(500, b""), OSError("reset"), (200, b"ok")]})
    assert web.client().download("https://a/x") == (b"ok", 200)
    assert len(web.asked) == 3 and 4.0 in web.slept
    final = Web({"https://a/x": [(404, b""), (200, b"ok")]})
    with pytest.raises(OSError, match="404"):
        final.client().download("https://a/x")
    assert len(final.asked) == 1


def test_hosts_are_not_pressed():
    web = Web({"https://a/1": (200, b""), "https://b/1": (200, b"")})
    client = web.client()
    for url in ("https://a/1", "https://b/1", "https://a/1"):
        client.request("GET", url)
    assert web.slept == [2.0]


def test_probe_and_check():
    web = Web({"https://a/x": [(405, b""), (206, b"%PDF")], "https://a/gone": (404, b""), "https://a/new": (200, b""), "https://a/other": (404, b"")})
    assert web.client().probe("https://a/x") == (200, "GET")
    got = fetch.check_url(web.client(), "https://a/gone", ["https://a/other"], lambda: ["https://a/new"])
    assert got["resolved_url"] == "https://a/new" and got["note"] == "resolved by landing page"
    assert fetch.check_url(web.client(), None, [], list)["status"] is None


def manifest_of(spark, docs):
    return spark.createDataFrame([tuple(d[f] for f in schemas.DOCUMENT_FIELDS) for d in docs], schemas.DOCUMENT)


def test_fetch_all(spark, tmp_path):
    docs = [DOC, DOC | {"doc_id": "W", "format": "web", "url": "https://a.example/p.json"}, DOC | {"doc_id": "E", "format": "embedded-in-oscal"}, DOC | {"doc_id": "M", "format": "pdf-manual"}, DOC | {"doc_id": "B", "url": "https://a.example/bad"}, DOC | {"doc_id": "C", "format": "oscal", "url": "https://a.example/c"}]
    web = Web({"https://a.example/x.pdf": (200, b" %PDF-1"), "https://a.example/bad": (200, b"<html>"), "https://a.example/p.json": (200, b"[1]"), "https://a.example/c": (200, b'{"catalog": {}}')})
    manifest = manifest_of(spark, docs)
    first = fetch.fetch_all(spark, manifest, tmp_path, web.client())
    assert {k: a for k, (a, _) in first.items()} == {"SP-1": "downloaded", "W": "skipped", "E": "skipped", "M": "manual-missing", "B": "failed", "C": "downloaded"}
    assert not list(tmp_path.rglob("*.incoming"))
    (tmp_path / "raw" / "manual").mkdir()
    (tmp_path / "raw" / "manual" / "M.pdf").write_bytes(b"%PDF")
    again = fetch.fetch_all(spark, manifest, tmp_path, web.client(), include_web=True)
    assert {k: a for k, (a, _) in again.items()}["SP-1"] == "cached" and again["W"][0] == "downloaded" and again["M"][0] == "manual"
    kept = json.loads((tmp_path / "provenance.json").read_text())["M"]["retrieved_at"]
    fetch.fetch_all(spark, manifest, tmp_path, web.client())
    entries = json.loads((tmp_path / "provenance.json").read_text())
    assert entries["M"]["retrieved_at"] == kept and entries["C"]["http_status"] == 200 and entries["W"]["skipped"] is True
    # What has been changed on disk is asked for again.
    (tmp_path / "raw" / "SP-1.pdf").write_bytes(b"%PDF other")
    assert fetch.fetch_all(spark, manifest, tmp_path, web.client())["SP-1"][0] == "downloaded"


def test_verify(spark, tmp_path, capsys):
    landing = b'<a href="/pubs/x1.pdf">the file</a> <p>This publication was superseded by Revision 7.</p>'
    dead = DOC | {"doc_id": "SP-x1", "url": "https://a.example/gone.pdf", "landing_page": "https://a.example/l", "revision": "Rev. 2", "notes": "check the landing page"}
    lost = DOC | {"doc_id": "SP-2", "url": "https://a.example/lost.pdf", "landing_page": "https://a.example/none"}
    none = DOC | {"doc_id": "N", "format": "pdf-manual", "url": None, "landing_page": "https://a.example/l"}
    web = Web({"https://a.example/x.pdf": (200, b""), "https://a.example/gone.pdf": (404, b""), "https://a.example/l": (200, landing), "https://a.example/pubs/x1.pdf": (200, b""), "https://a.example/lost.pdf": (404, b""), "https://a.example/none": (500, b"")})
    got = {r.doc_id: r for r in fetch.verify(spark, manifest_of(spark, [DOC, dead, lost, none]), web.client()).collect()}
    assert (got["SP-1"].status, got["SP-1"].resolved_url, got["SP-1"].signals) == (200, None, None)
    assert got["SP-x1"].resolved_url == "https://a.example/pubs/x1.pdf" and "superseded" in got["SP-x1"].signals and "[7]" in got["SP-x1"].signals
    assert got["SP-2"].status == 404 and got["N"].note == "no url"
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"manifest_version": 1, "dataset_name": "d", "maintainer": "m", "documents": [DOC, dead, lost, none]}))
    assert main(["verify", str(path), str(tmp_path / "report.md")], spark, web.client()) == 1
    report = (tmp_path / "report.md").read_text()
    assert "`SP-2` does not answer" in report and "pubs/x1.pdf" in report and "`N` is placed by hand" in report and "`SP-x1` (Rev. 2)" in report


def test_pdf_lines(spark, tmp_path):
    rows = [
        ("D", 3, 0, 70.26, [("12 ", 6.0, 0), ("A heading", 13.04, 16)]), ("D", 3, 1, 0.0, [("  ", 6.0, 0)]), ("D", 3, 2, 0.0, []), ("D", 4, 3, 1.0, [("same", 9.0, 16), ("size", 8.0, 0), (" ", 20.0, 0)]),
    ]
    got = pdf.lines_of(spark.createDataFrame(rows, pdf.SPANS)).orderBy("line_no").collect()
    assert [tuple(r) for r in got] == [("D", 0, "12 A heading", 3, 13.0, True, 70.3), ("D", 3, "samesize", 4, 9.0, True, 1.0)]
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "SP-1.pdf").write_bytes(b"%PDF")
    (tmp_path / "other.txt").write_bytes(b"")
    files = pdf.read_files(spark, str(tmp_path))
    assert [r.doc_id for r in files.collect()] == ["SP-1"]
    if pdf.pymupdf is None:
        with pytest.raises(ImportError):
            pdf.spans(files)


def test_stages(spark, tmp_path, capsys):
    (tmp_path / "m.json").write_text(json.dumps({"manifest_version": 1, "dataset_name": "d", "maintainer": "m", "documents": [DOC, DOC | {"doc_id": "CAT", "format": "oscal"}]}))
    (tmp_path / "p.json").write_text(json.dumps({d: {"sha256": "f", "bytes": 1, "retrieved_at": "t", "url": "u", "http_status": 200, "source": "download", "skipped": False, "note": ""} for d in ("SP-1", "CAT")}))
    assert main(["manifest", str(tmp_path / "m.json")], spark) == 0 and "2 documents" in capsys.readouterr().out
    (tmp_path / "bad.json").write_text("{}")
    assert main(["manifest", str(tmp_path / "bad.json")], spark) == 1
    tree = {"catalog": {"groups": [{"id": "ac", "title": "T", "controls": [{"id": "ac-1", "title": "Policy", "parts": [{"name": "statement", "prose": "Keep the policy up to date and tell everybody who is concerned about it."}]}]}]}}
    spark.createDataFrame([(1, "CAT", json.dumps(tree))], "file_id bigint, doc_id string, mini_catalog string").write.parquet(str(tmp_path / "files"))
    common = [str(tmp_path / "m.json"), str(tmp_path / "p.json")]
    assert main(["catalog", str(tmp_path / "files"), *common, str(tmp_path / "cat")], spark) == 0
    lines = [("1 Scope", 13.0)] + [(f"Line {w} says what the publication is about and for whom.", 10.0) for w in ("one", "two", "three", "four", "five")]
    spark.createDataFrame([("SP-1", k, t, 1, s, False, 0.0) for k, (t, s) in enumerate(lines)], schemas.LINE).write.parquet(str(tmp_path / "laid"))
    assert main(["lines", str(tmp_path / "laid"), *common, str(tmp_path / "pdf")], spark) == 0
    interim = tmp_path / "interim"
    interim.mkdir()
    for name in ("cat", "pdf"):
        (interim / f"{name}.rows.jsonl").write_text("".join(p.read_text() for p in (tmp_path / name / "rows").glob("*.json")))
    assert main(["chunk", str(interim), str(tmp_path / "chunked")], spark) == 0
    assert main(["validate", str(tmp_path / "chunked" / "rows"), *common, str(tmp_path / "valid")], spark) == 0
    assert "Rows published: **2**" in (tmp_path / "valid" / "summary.md").read_text()
    assert main(["export", str(tmp_path / "valid" / "rows"), str(tmp_path / "final")], spark) == 0
    assert [r.id for r in spark.read.parquet(str(tmp_path / "final")).collect()] == ["CAT/control/ac-1", "SP-1/section/1-scope"]
