"""Each validation rule on a row bent in one field, the greedy duplicate pass, and that every row is accounted for."""

from __future__ import annotations

import random

import pytest

from quern.operators import dedupe, ordered, rules

GOOD = dict(seq=1, id="SP-1/section/a", text="The owner reviews the plan. " * 10, doc_id="SP-1", doc_title="T", revision="", pub_date="2020", tier=1, chunk_type="section", control_id=None, section_path="1 Scope", source_url="https://a.example", sha256_source="f" * 64)
SCHEMA = "seq bigint, id string, text string, doc_id string, doc_title string, revision string, pub_date string, tier int, chunk_type string, control_id string, section_path string, source_url string, sha256_source string"


@pytest.fixture(scope="module")
def dimensions(spark):
    manifest = spark.createDataFrame([("SP-1", "pdf"), ("CAT", "oscal"), ("CAT", "oscal")], "doc_id string, format string")
    provenance = spark.createDataFrame([("SP-1", "f" * 64), ("X", None)], "doc_id string, sha256 string")
    return manifest, provenance


BENT = [
    ({"text": None}, "schema_valid"), ({"chunk_type": "chapter"}, "schema_valid"), ({"tier": 3}, "schema_valid"), ({"doc_id": "SP-9"}, "doc_in_manifest"), ({"sha256_source": "0" * 64}, "doc_in_manifest"), ({"doc_id": "CAT", "control_id": "ha-25"}, "control_family_whitelist"),
    ({"control_id": "ac-2"}, "control_id_source"), ({"text": "APPENDIX B PAGE B-2 tiny"}, "running_header_fragment"), ({"section_path": "A > T > B", "text": "short"}, "running_header_fragment"), ({"text": "x" * 199}, "length_bounds"), ({"text": "x" * 8001}, "length_bounds"),
    ({"text": GOOD["text"] + "{{ x }}"}, "no_template_residue"), ({"text": "NIST SP 800-53 Page 7 " + GOOD["text"]}, "no_furniture"), ({"text": "Ross, R. (2018) " + GOOD["text"]}, "bibliography_entry"), ({"text": "and so " + GOOD["text"]}, "midsentence_fragment"), ({"text": GOOD["text"] + "�"}, "encoding_clean"),
    ({"doc_id": "CAT", "control_id": "ac-2", "chunk_type": "control", "text": "x" * 80}, None), ({"text": "X" * 8000}, None), ({"chunk_type": "task", "text": "and so " + GOOD["text"]}, None), ({"section_path": None}, None),
]


@pytest.mark.parametrize("change,rule", BENT, ids=range(len(BENT)))
def test_rules(spark, dimensions, change, rule):
    df = spark.createDataFrame([tuple((GOOD | change)[k] for k in GOOD)], SCHEMA)
    if rule == "encoding_clean":
        assert df.select(rules.encoding_fails(df.text)).first()[0]
        return
    failed = rules.tagged(df, *dimensions).first().failed
    assert (failed.rule if failed else None) == rule


def test_every_row_is_valid_or_rejected(spark, dimensions):
    rows = [GOOD | change | {"seq": k, "id": f"i{k}"} for k, (change, _) in enumerate(BENT)]
    rows += [GOOD | {"seq": 100, "id": "i17"}, GOOD | {"seq": 101, "id": "new", "text": GOOD["text"].upper()}]
    df = spark.createDataFrame([tuple(r[k] for k in GOOD) for r in rows], SCHEMA)
    valid, rejected = rules.validate(df, *dimensions)
    got = [r.rule for r in rejected.collect()]
    assert valid.count() + len(got) == len(rows)
    assert {"unique_id", "near_dupe", "encoding_clean"} <= set(got)
    again, none = rules.validate(valid, *dimensions)
    assert again.count() == valid.count() and none.count() == 0
    assert rules.validate(df.where("false"), *dimensions)[0].count() == 0


def sequential(rows):
    ids, prints, out = set(), set(), {}
    for order, left, right, registers in sorted(rows):
        if left is not None and left in ids:
            out[order] = "left"
        elif right is not None and right in prints:
            out[order] = "right"
        elif not registers:
            out[order] = "unregistered"
        else:
            out[order] = "accepted"
            ids.add(left)
            prints.add(right)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_greedy(spark, seed):
    rng = random.Random(seed)
    n = 250
    rows = [(k, rng.choice([None, *"abcdefghijklmnop"[: 4 + 3 * seed]]) if rng.random() < 0.8 else f"l{k}", rng.choice([None, *"ABCDEFGH"]) if rng.random() < 0.5 else f"r{k}", rng.random() < 0.9) for k in range(n)]
    df = spark.createDataFrame(rows, "o bigint, l string, r string, g boolean")
    assert {r.o: r.verdict for r in dedupe.greedy(df, "o", "l", "r", "g").collect()} == sequential(rows)


def test_greedy_chain(spark):
    """Alternating keys make a chain in which every second row stands."""
    rows = [(k, f"l{k // 2}", f"r{(k + 1) // 2}", True) for k in range(12)]
    df = spark.createDataFrame(rows, "o bigint, l string, r string, g boolean")
    assert {r.o: r.verdict for r in dedupe.greedy(df, "o", "l", "r").collect()} == sequential(rows)


def test_ordered_helpers(spark):
    from pyspark.sql import functions as F

    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", None]), k * 3, rng.choice([None, None, k])) for k in range(200)]
    df = spark.createDataFrame(rows, "k string, o bigint, v int")
    sums = {r.o: r.s for r in ordered.running_sum(df, "s", F.col("v"), ["k"], "o").collect()}
    last = {r.o: r.x for r in ordered.carried(df, {"x": F.col("v")}, ["k"], "o").collect()}
    after = {r.o: r.x for r in ordered.carried(df, {"x": F.col("v")}, ["k"], "o", forward=False, current=False).collect()}
    for key in ("a", "b", None):
        group = [r for r in rows if r[0] == key]
        for i, (_, o, _) in enumerate(group):
            before = [v for *_, v in group[: i + 1] if v is not None]
            later = [v for *_, v in group[i + 1 :] if v is not None]
            assert sums[o] == sum(before) and last[o] == (before[-1] if before else None) and after[o] == (later[0] if later else None)
    assert {tuple(r) for r in ordered.first_rows(df.where("k IS NOT NULL"), ["k"], [F.col("o")], ["v"]).collect()} == {(k, next(r[2] for r in rows if r[0] == k)) for k in ("a", "b")}
