"""A small catalog with every case: rows, texts, rejections, order."""

from __future__ import annotations

import json

import pytest

from quern.operators import catalog

LABEL = lambda v, c=None: {"name": "label", "value": v} | ({"class": c} if c else {})
CATALOG = {
    "catalog": {
        "groups": [
            {
                "id": "ac", "title": "Access Control", "params": [{"id": "g_prm", "label": "group value"}],
                "controls": [
                    {
                        "id": "ac-1", "title": "Policy", "props": [LABEL("AC-1")],
                        "params": [{"id": "p1", "label": "frequency"}, {"id": "p2", "select": {"how-many": "one-or-more", "choice": ["lock {{ insert: param, p1 }}", "notify"]}}, {"id": "p1", "label": "final frequency"}],
                        "parts": [
                            {"id": "s", "name": "statement", "props": [LABEL("X.")], "prose": "Do this:", "parts": [
                                {"name": "item", "props": [LABEL("a.")], "prose": "Review {{ insert: param, p1 }} and {{insert: param, p2}}", "parts": [{"name": "item", "props": [LABEL("1."), LABEL("AC-1a.[01]", "sp800-53a")], "prose": "deep"}]},
                                {"name": "item", "props": [LABEL("b.")]}, {"name": "item", "props": [LABEL("c.")], "parts": [{"name": "item", "props": [LABEL("c.1", "sp800-53a")], "prose": "inner {{ insert: param, none }}"}]},
                            ]},
                            {"name": "guidance", "prose": "Some guidance with {{ insert: param, g_prm }}."},
                            {"name": "assessment-objective", "props": [LABEL("AC-01", "sp800-53a")], "parts": [{"name": "assessment-objective", "props": [LABEL("AC-01a", "sp800-53a")], "prose": "is defined"}]},
                            {"name": "assessment-method", "props": [{"name": "method", "value": "EXAMINE"}], "parts": [{"name": "assessment-objects", "props": [LABEL("zz")], "prose": "policy\nplan"}]},
                            {"name": "assessment-method", "props": [{"name": "method", "value": "TEST-IT NOW"}], "parts": [{"name": "assessment-objects", "prose": "mechanisms"}]},
                        ],
                        "controls": [
                            {"id": "ac-1.1", "title": "Automation", "parts": [{"name": "statement", "prose": "Automate."}, {"name": "guidance", "prose": "None."}]},
                            {"id": "ac-1.2", "title": "Old", "props": [{"name": "status", "value": "withdrawn"}], "controls": [{"id": "ac-1.2.1", "title": "Child", "parts": [{"name": "statement", "prose": "Lives."}]}]},
                        ],
                    },
                    {"id": "ac-99", "title": "Gone", "props": [{"name": "status", "value": "withdrawn"}]}, {"title": "No id"}, {"id": "ac-3", "title": "Bare"},
                ],
            }
        ]
    }
}


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame([(1, "CAT", json.dumps(CATALOG)), (2, "BAD", "<html>"), (3, "NONE", None)], "file_id bigint, doc_id string, mini_catalog string")


def test_rows(files):
    rows, rejected, counts = catalog.parse_catalogs(files, "SP-A")
    got = rows.orderBy("file_id", "order", "kind_order").collect()
    assert [(r.chunk_type, r.control_id) for r in got] == [
        ("control", "ac-1"), ("control_discussion", "ac-1"), ("assessment_objective", "ac-1"), ("assessment_method", "ac-1"), ("control_enhancement", "ac-1.1"), ("control_enhancement", "ac-1.2.1"),
    ]
    texts = {(r.chunk_type, r.control_id): r for r in got}
    assert texts["control", "ac-1"].text == (
        "AC-1 Policy\nFamily: Access Control (AC)\n\nDo this:\na. Review [Assignment: organization-defined final frequency] and "
        "[Selection; one or more: lock [Assignment: organization-defined final frequency]; notify]\n1. deep\nb.\nc.1 inner [Assignment: organization-defined parameter]"
    )
    assert texts["control_discussion", "ac-1"].text.endswith("Some guidance with [Assignment: organization-defined group value].")
    assert texts["assessment_objective", "ac-1"].text.endswith("Determine if the following are satisfied:\n\nAC-01a is defined")
    assert texts["assessment_method", "ac-1"].text == "AC-1 Policy - Assessment Methods and Objects\n\nExamine: policy\nplan\n\nTest-It Now: mechanisms"
    enhancement = texts["control_enhancement", "ac-1.1"]
    assert enhancement.text == "AC-1(1) Policy | Automation\nFamily: Access Control (AC) > AC-1 Policy\n\nAutomate." and enhancement.section_path == "AC > AC-1 > AC-1(1)"
    assert texts["control", "ac-1"].id == "CAT/control/ac-1" and texts["assessment_method", "ac-1"].id == "SP-A/assessment_method/ac-1"
    assert sorted((r.rule, r.ref) for r in rejected.collect()) == [("empty_discussion", "ac-1.1"), ("no_id", ""), ("no_statement", "ac-3"), ("withdrawn_control", "ac-1.2"), ("withdrawn_control", "ac-99")]
    assert {(r.family, r.kind): r.n for r in counts.collect()}["ac", "withdrawn"] == 2
    assert catalog.parse_catalogs(files, None)[0].where("chunk_type LIKE 'assessment%'").count() == 0


def test_names_and_unresolved(files):
    assert {r.name: r.n for r in catalog.part_names(files).collect()}["statement"] == 3
    assert [(r.param_id, r.n) for r in catalog.unresolved_params(files).collect()] == [("none", 1)]


def test_parameters_that_refer_to_themselves_end(spark):
    loop = {"catalog": {"groups": [{"id": "ac", "controls": [{"id": "ac-1", "params": [{"id": "x", "label": "{{ insert: param, x }}"}], "parts": [{"name": "statement", "prose": "see {{ insert: param, x }}"}]}]}]}}
    df = spark.createDataFrame([(1, "C", json.dumps(loop))], "file_id bigint, doc_id string, mini_catalog string")
    text = catalog.parse_catalogs(df)[0].first().text
    assert "insert: param" not in text


def test_profiles(spark):
    profile = {"profile": {"metadata": {"title": "Low"}, "imports": [{"include-controls": [{"with-ids": ["au-2", "ac-11", "ac-2"]}, {"with-ids": ["ac-2.1", "ac-2"]}]}, {}]}}
    df = spark.createDataFrame([("SP-B-LOW", "Title", json.dumps(profile)), ("SP-B-NONE", "Title", "{}")], "doc_id string, doc_title string, profile string")
    got = {r.doc_id: r for r in catalog.parse_profiles(df).collect()}
    assert got["SP-B-LOW"].text.endswith("AC-2, AC-2(1), AC-11, AU-2") and "4 controls and control enhancements (3 base controls, 1 enhancements)" in got["SP-B-LOW"].text
    assert got["SP-B-LOW"].id == "SP-B-LOW/baseline/low"


def test_empty(spark):
    df = spark.createDataFrame([], "file_id bigint, doc_id string, mini_catalog string")
    rows, rejected, counts = catalog.parse_catalogs(df)
    assert rows.count() == rejected.count() == counts.count() == 0
