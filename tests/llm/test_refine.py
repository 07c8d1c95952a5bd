"""Problem 2: classes of copies against brute force."""

from __future__ import annotations

import json
import random

import pytest

from quern.llm import marks as M
from quern.llm import refine as R

BASE = {"id": "A/1", "text": "Grüße aus dem Café. Straße 5, oﬃce!", "doc_id": "A", "doc_title": None, "revision": "", "pub_date": "2020", "tier": 1, "chunk_type": "task", "control_id": None, "section_path": "1 X > 2 Y", "source_url": "https://a.example", "sha256_source": "ff"}


def dressed(record: dict, rng: random.Random) -> str:
    """The same letters and digits in another outward form."""
    out = {}
    names = list(record)
    rng.shuffle(names)
    for name in names:
        value = record[name]
        if value is None:
            if rng.random() < 0.5:
                out[name] = rng.choice(["", " - ", None])
            continue
        text = str(value)
        if rng.random() < 0.4:
            text = rng.choice([str.upper, str.lower, str.title])(text)
        text = "".join(c + rng.choice(["", "", "", "​", " ", "-", "­", "\n"]) for c in text)
        out[name] = int(value) if isinstance(value, int) and rng.random() < 0.5 else text
    return json.dumps(out, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2]))


def brute(rows: list[tuple[int, str | None]]) -> set[tuple[int, int]]:
    classes: dict = {}
    for rec_id, payload in rows:
        try:
            record = json.loads(payload, parse_int=str, parse_float=str)
        except (TypeError, ValueError):
            continue
        if isinstance(record, dict):
            key = tuple(sorted((k, v) for k, v in ((k, R.sequence(v)) for k, v in record.items()) if v))
            classes.setdefault(key, []).append(rec_id)
    return {(min(c), r) for c in classes.values() for r in c if r != min(c)}


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows: list[tuple[int, str | None]] = []
    for k in range(60):
        record = BASE | {"id": f"A/{k}", "text": f"{BASE['text']} {'word ' * rng.randint(0, 5)}{k % 7}"}
        rows += [(len(rows) + i, dressed(record, rng)) for i in range(rng.choice([1, 1, 2, 5]))]
    # A hot group, near misses, anagrams (same histogram), unreadable and odd payloads.
    rows += [(1_000 + i, dressed(BASE, rng)) for i in range(150)]
    rows += [(2_000, json.dumps(BASE | {"id": "1A"})), (2_001, json.dumps(BASE | {"id": "A1"})), (2_002, json.dumps(BASE)[:-9]), (2_003, json.dumps(BASE)[:-9]), (2_004, None), (2_005, ""), (2_006, "[]"), (2_007, "[]"), (2_008, "{}"), (2_009, "{ }")]
    big = json.dumps(BASE | {"text": "long " * 100_000})
    rows += [(3_000, big), (3_001, big)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(a, b, 7, "clash") for a, b in rows], "rec_id bigint, payload string, copies int, cheap string")
    got = R.copies(df).collect()
    assert {(r.kept_rec_id, r.rec_id) for r in got if r.rec_id != r.kept_rec_id} == brute(rows)
    # 150 dressed copies, and the record whose id differs only in punctuation.
    assert {r.copies for r in got if r.kept_rec_id == 1_000} == {151}
    kept = {r.rec_id: r.copies for r in R.collapsed(df).collect()}
    assert len(kept) == len(rows) - len(brute(rows))
    assert kept[2_004] == kept[2_002] == 1


def test_bitmap_may_be_full(spark, monkeypatch):
    """With a bitmap of one word everything passes it, and the result is the same."""
    rng = random.Random(4)
    rows = [(i, dressed(BASE | {"id": str(i // 2)}, rng)) for i in range(40)] + [(100 + i, dressed(BASE | {"id": f"x{i}"}, rng)) for i in range(300)]
    df = spark.createDataFrame(rows, "rec_id bigint, payload string")
    expected = {(r.kept_rec_id, r.rec_id) for r in R.copies(df).collect()}
    whole = sorted(tuple(r) for r in R.collapsed(df).collect())
    monkeypatch.setattr(M, "LEAST_BITS", 1)
    monkeypatch.setattr(M, "MOST_BITS", 1)
    assert {(r.kept_rec_id, r.rec_id) for r in R.copies(df).collect()} == expected
    assert sorted(tuple(r) for r in R.collapsed(df).collect()) == whole


def test_no_record_is_lost(spark):
    """Different records may share a rec_id or have none; only copies go, and each class keeps one."""
    one, two, three = (json.dumps(BASE | {"id": x}) for x in ("one", "two", "three"))
    rows = [(None, one), (None, two), (None, one), (1, one), (1, two), (2, two.upper().replace("NULL", "null")), (2, two), (3, three), (3, three), (4, "{cut"), (4, "{cut"), (5, None)]
    df = spark.createDataFrame(rows, "rec_id bigint, payload string")
    got = sorted(((r.rec_id or 0), r.payload or "", r.copies) for r in R.collapsed(df).collect())
    assert got == sorted([(0, one, 1), (0, two, 1), (0, one, 1), (1, one, 1), (1, two, 2), (2, two.upper().replace("NULL", "null"), 1), (3, three, 2), (4, "{cut", 1), (4, "{cut", 1), (5, "", 1)])


def test_nested_values_count_without_their_form(spark):
    rows = [(1, '{"text": {"p": "x\\ny", "q": [1, null]}}'), (2, '{"text": {"q": [1,null], "p": "x y"}}'), (3, '{"text": {"p": "xny", "q": [1, null]}}'), (4, '{"text": {"p": "x\\u0020y", "q": [1, null]}, "id": " - "}')]
    df = spark.createDataFrame(rows, "rec_id bigint, payload string")
    assert {(r.kept_rec_id, r.rec_id) for r in R.copies(df).collect() if r.rec_id != r.kept_rec_id} == {(1, 2), (1, 4)}


def test_empty(spark):
    df = spark.createDataFrame([], "rec_id bigint, payload string")
    assert R.copies(df).count() == 0 and R.collapsed(df).count() == 0


@pytest.mark.parametrize("a,b,same", [("Straße", "STRASSE", True), ("oﬃce", "OFFICE", True), ("é", "É", True), ("a1", "a-1", True), ("ab", "ba", False), ("1", 1, True), (None, " ", True), ("½", "1", False)])
def test_sequence(a, b, same):
    assert (R.sequence(a) == R.sequence(str(b) if isinstance(b, int) else b)) == same
