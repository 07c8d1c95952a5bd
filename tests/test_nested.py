"""Trees as flat tables, against a plain walk over the same JSON."""

from __future__ import annotations

import json
import random

import pytest

from quern.operators import nested

KINDS = list(nested.OSCAL_KINDS)


def random_tree(rng: random.Random, depth: int = 0) -> dict:
    node: dict = {}
    if rng.random() < 0.8:
        node["id"] = rng.choice(["a", "b.1", "", None, 7])
    for kind in KINDS:
        if rng.random() < (0.7 if depth < 5 else 0.0):
            choice = rng.random()
            children = [rng.choice([random_tree(rng, depth + 1), random_tree(rng, depth + 1), None, "text", 3]) for _ in range(rng.randint(0, 3))]
            node[kind] = children if choice < 0.7 else random_tree(rng, depth + 1) if choice < 0.85 else rng.choice([None, "plain", [], {}])
    return node


def walk(key, node, path, out):
    for field, kind in nested.OSCAL_KINDS.items():
        value = node.get(field)
        for i, child in enumerate(value if isinstance(value, list) else [value]):
            if isinstance(child, dict):
                here = f"{path}.{field}.{i}".lstrip(".")
                own = child.get("id")
                out.append((key, field, here, path, i, "" if own is None else str(own)))
                walk(key, child, here, out)


def test_against_a_walk(spark):
    rng = random.Random(8)
    texts = [json.dumps({"catalog": random_tree(rng)}, indent=rng.choice([None, 2])) for _ in range(60)]
    odd = [None, "", "  ", "<html>", "[]", "3", "{}", '{"catalog": null}', '{"catalog": []}', '{"catalog": {"groups": {}}}', texts[0], texts[0][:-3], '{"other": {"groups": []}}']
    rows = [(k, t, "clash", "x") for k, t in enumerate(texts + odd)] + [(None, texts[1], "clash", "x"), (3, texts[3], "clash", "x")]
    expected = []
    for key, text, *_ in rows:
        try:
            record = json.loads(text)
        except (TypeError, ValueError):
            continue
        if isinstance(record, dict) and isinstance(record.get("catalog"), dict):
            walk(key, record["catalog"], "", expected)
    df = spark.createDataFrame(rows, "file_id bigint, mini_catalog string, path string, kind string")
    got = [(r.file_id, r.kind, r.path, r.parent, r.ordinal, r.node_id) for r in nested.catalog_nodes(df).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=order) == sorted(expected, key=order)


def test_links_and_columns(spark):
    text = json.dumps({"catalog": {"groups": [{"id": "ac", "title": "T", "controls": {"id": "ac-1", "params": [{"id": "p", "select": {"how-many": "one", "choice": ["x", "y"]}}]}}]}})
    df = spark.createDataFrame([(1, text)], "file_id bigint, mini_catalog string")
    nodes = {r.path: r for r in nested.catalog_nodes(df).collect()}
    assert nodes["groups.0.controls.0"].parent_key == nodes["groups.0"].node_key and nodes["groups.0"].parent_key is None
    param = nested.catalog_table(df, "params").first()
    assert (param.how_many, json.loads(param.choice), param.parent) == ("one", ["x", "y"], "groups.0.controls.0")


def test_merged_schema(spark):
    df = spark.createDataFrame([('{"catalog": {"groups": [{"id": 1}]}}',), ('{"catalog": {"groups": {"id": "x", "controls": [{}]}}}',), (None,), ("x",)], "j string")
    got = {(r.kind, r.field, r.type) for r in nested.infer_schema(df, "j", "catalog").collect()}
    assert got == {("catalog", "groups", "array<object>"), ("catalog", "groups", "object"), ("groups", "id", "bigint"), ("groups", "id", "string"), ("groups", "controls", "array<object>")}


def test_any_record(spark):
    """Without a list of fields, all fields that hold arrays of objects are tables, also with odd names."""
    record = {"r": {"it's": [{"x.y": [{"id": "deep"}]}], "plain": {"id": "no table"}}}
    df = spark.createDataFrame([("k", json.dumps(record))], "key string, j string")
    got = {(r.kind, r.path, r.node_id) for r in nested.nodes(df, "key", "j", "r").collect()}
    assert got == {("it's", "it's.0", ""), ("x.y", "it's.0.x.y.0", "deep")}


def test_empty_and_bounds(spark, monkeypatch):
    df = spark.createDataFrame([], "file_id bigint, mini_catalog string")
    assert nested.catalog_nodes(df).count() == 0
    # Any number of fields is read where the child tables are named; without names each is a step of the plan.
    wide = spark.createDataFrame([(1, json.dumps({"catalog": {f"f{k}": [{"id": k}] for k in range(50)} | {"groups": [{"id": "g"}]}}))], "file_id bigint, mini_catalog string")
    monkeypatch.setattr(nested, "MAX_FIELDS", 10)
    assert nested.catalog_nodes(wide).count() == 1
    with pytest.raises(ValueError, match="arrays of objects"):
        nested.nodes(wide, "file_id", "mini_catalog", "catalog")


def test_very_long_text(spark):
    tree = {"catalog": {"groups": [{"id": f"g{k}", "title": "t" * 500} for k in range(4_000)]}}
    df = spark.createDataFrame([(1, json.dumps(tree))], "file_id bigint, mini_catalog string")
    assert nested.catalog_nodes(df).count() == 4_000
