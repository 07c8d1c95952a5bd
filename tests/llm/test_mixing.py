"""Problem 7: counts by shard, permutations, places and shares."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import mixing as M


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 3_000), st.integers(0, 10**9))
def test_permutation(n, key):
    there = M.permuted(np.arange(n), n, key)
    assert sorted(there.tolist()) == list(range(n))
    assert (M.permuted(there, n, key, back=True) == np.arange(n)).all()


def test_permutation_depends_on_its_key():
    assert (M.permuted(np.arange(500), 500, 1) != M.permuted(np.arange(500), 500, 2)).mean() > 0.9


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=6), st.integers(1, 90))
def test_shard_counts_add_up(totals, shard_slots):
    totals = np.array(totals)
    shards = -(-int(totals.sum()) // shard_slots)
    before = np.zeros(len(totals), dtype=int)
    for shard in range(shards):
        counts, offset = M.shard_counts(totals, shard, shards, shard_slots, 7)
        assert (offset == before).all() and (counts >= 0).all()
        assert counts.sum() == min(shard_slots, totals.sum() - shard * shard_slots)
        before += counts
    assert (before == totals).all() or shards == 0


def test_proportional_above_the_exact_size(monkeypatch):
    monkeypatch.setattr(M, "_EXACT", 100)
    totals = np.array([700, 200, 101])
    before = np.zeros(3, dtype=int)
    for shard in range(21):
        counts, offset = M.shard_counts(totals, shard, 21, 50, 1)
        assert (offset == before).all()
        before += counts
    assert (before == totals).all()


def test_plan():
    targets = [{"source": "a", "target_share": 0.5, "max_repeats": 1}, {"source": "b", "target_share": 0.25, "max_repeats": 2}, {"source": "none", "target_share": 0.25, "max_repeats": 9}]
    planned = {t["source"]: t for t in M.plan(targets, {"a": 1_000, "b": 10_000}, 10)}
    assert (planned["a"]["slots"], planned["b"]["slots"], planned["none"]["slots"]) == (100, 50, 0)
    assert sum(t["wanted"] for t in M.plan(targets, {"a": 1_000, "b": 10_000}, 10, total_tokens=300)) == 300
    assert sum(t["slots"] for t in M.plan(targets, {}, 10)) == 0
    assert M.plan([], {"a": 5}, 10) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(0, 5_000), st.integers(1, 4)), min_size=1, max_size=6), st.integers(1, 300))
def test_shares_are_met_to_the_token(sources, block):
    """Every source gives its share of the tokens, but for rounding, and none more often than it may."""
    targets = [{"source": str(k), "target_share": w / sum(x for x, _, _ in sources), "max_repeats": r} for k, (w, _, r) in enumerate(sources)]
    available = {str(k): n for k, (_, n, _) in enumerate(sources)}
    planned = M.plan(targets, available, block)
    total, whole = sum(t["wanted"] for t in planned), sum(t["target_share"] for t in planned if t["available"])
    for t in planned:
        n, left = t["blocks"], t["available"] % block
        tokens = [block] * (t["available"] // block) + [left] * (left > 0)
        given = [tokens[k % n] for k in range(t["slots"])] if n else []
        if given:
            given[-1] = min(given[-1], t["last"])
        assert sum(given) == t["wanted"] <= t["available"] * t["max_repeats"] and t["slots"] <= n * t["max_repeats"]
        if t["available"]:
            assert abs(t["wanted"] - total * t["target_share"] / whole) <= 1 + len(planned)
    assert any(t["wanted"] >= t["available"] * t["max_repeats"] - 1 for t in planned if t["available"]) or not total


TEXT = "The owner keeps the key in the box. "


def frames(spark):
    rows = [(k, TEXT * (1 + k % 5), ["big", "BIG", " big-"][k % 3] if k % 3 else "big", 1) for k in range(300)]
    rows += [(1_000 + k, TEXT * 3, "Small Source", 1) for k in range(10)] + [(2_000, None, "big", 1), (2_001, "", "big", 1), (2_002, TEXT, None, 1), (2_003, TEXT, "unwanted", 1), (None, TEXT, "big", 1), (5, TEXT, "big", 1), (2_004, TEXT * 3_000, "small_source", 1)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, source string, tokens int")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small_source", 0.3, 3), ("absent", 0.1, 5), ("big", 0.0, 1), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    return documents, targets


def test_mixture(spark):
    documents, targets = frames(spark)
    mixed = M.mixture(documents, targets, block_tokens=16).collect()
    assert len({(r.shard, r.slot) for r in mixed}) == len(mixed)
    assert len({(r.source, r.repeat, r.block) for r in mixed}) == len(mixed)
    assert max(r.repeat for r in mixed if r.source == "big") == 1 and max(r.repeat for r in mixed if r.source == "small_source") <= 3
    # Parts of a block are tokens of documents, and the ids are those tokens; each block is full but for the last of its source.
    encode = M.tokenizer(M.VOCABULARY).encode_ordinary
    known: dict = {}
    for r in documents.where("text IS NOT NULL AND doc_id IS NOT NULL").collect():
        known.setdefault(r.doc_id, []).append(encode(r.text))
    for r in mixed:
        assert r.tokens == len(r.ids) == sum(p.to_token - p.from_token for p in r.parts) <= 16
        assert [p["at"] for p in r.parts] == sorted(p["at"] for p in r.parts)
        at = 0
        for p in r.parts:
            here = r.ids[at : at + p.to_token - p.from_token]
            assert here and any(ids[p.from_token : p.to_token] == here for ids in known[p.doc_id])
            at += len(here)
    short = [r for r in mixed if r.tokens < 16]
    assert len(short) <= 2 + max(r.repeat for r in mixed)
    big, small = (sum(r.tokens for r in mixed if r.source == s) for s in ("big", "small_source"))
    assert abs(big - 2 * small) <= 3
    again = M.mixture(documents, targets, block_tokens=16).collect()
    assert sorted((r.shard, r.slot, r.source, r.block) for r in again) == sorted((r.shard, r.slot, r.source, r.block) for r in mixed)


def test_every_token_has_its_place(spark):
    documents, targets = frames(spark)
    places = M.placed(M.encoded(documents, M.clean_targets(targets)), buckets=7).collect()
    for source in ("big", "small_source"):
        mine = sorted((r.place, r.tokens) for r in places if r.source == source)
        assert [a for a, _ in mine] == [sum(n for _, n in mine[:k]) for k in range(len(mine))]


def test_shares_and_texts(spark):
    documents, targets = frames(spark)
    got = {r.source: r for r in M.shares(documents, targets, block_tokens=16).collect()}
    assert got["absent"].actual_share == 0 and got["absent"].documents == 0
    assert got["big"].actual_share == pytest.approx(got["big"].reachable_share, abs=1e-4)
    mixed = M.mixture(documents, targets, block_tokens=16)
    counted = {r.source: r.n for r in mixed.groupBy("source").agg({"tokens": "sum"}).withColumnRenamed("sum(tokens)", "n").collect()}
    assert counted == {s: got[s].mixture_tokens for s in counted}
    texts = M.texts(mixed).collect()
    assert len(texts) == mixed.count() and all(t.text in TEXT * 4_000 for t in texts if len(t.text) < 60)


def test_empty(spark):
    documents, targets = frames(spark)
    assert M.mixture(documents.where("false"), targets).count() == 0
    assert M.mixture(documents, targets.where("false")).count() == 0
