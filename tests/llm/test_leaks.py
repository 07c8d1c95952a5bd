"""Problem 6: the automaton finds exactly the shared runs of words that brute force finds."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import leaks as L

TOKENS = st.lists(st.sampled_from("abcdex"), max_size=40)


@settings(max_examples=400, deadline=None)
@given(st.lists(TOKENS, min_size=1, max_size=5), TOKENS, st.integers(1, 5))
def test_automaton_against_brute_force(items, text, least):
    automaton = L.SuffixAutomaton(list(enumerate(items)), least)
    got = {(end, item) for end, _, state in automaton.matches(text) for item in automaton.items[automaton.home[state]]}
    expected = {(end, k) for end in range(least - 1, len(text)) for k, item in enumerate(items) if any(item[i : i + least] == text[end - least + 1 : end + 1] for i in range(len(item) - least + 1))}
    assert got == expected


@settings(max_examples=200, deadline=None)
@given(st.lists(TOKENS, min_size=1, max_size=4), TOKENS)
def test_matching_lengths(items, text):
    automaton = L.SuffixAutomaton(list(enumerate(items)), 2)

    def longest(end):
        n = 0
        while n <= end and any(item[i : i + n + 1] == text[end - n : end + 1] for item in items for i in range(len(item) - n)):
            n += 1
        return n

    assert {(end, n) for end, n, _ in automaton.matches(text)} == {(e, longest(e)) for e in range(len(text)) if longest(e) >= 2}


PASSAGE = "one two three four five six seven eight nine ten eleven twelve"


def frames(spark):
    docs = [(1, f"Before. {PASSAGE.upper()}! after"), (1, f"Before. {PASSAGE.upper()}! after"), (2, PASSAGE.replace(" ", "--") + " x"), (3, PASSAGE[:-7]), (4, None), (5, ""), (6, "filler " * 50_000 + PASSAGE), (None, PASSAGE)]
    documents = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, item_id string")
    items = spark.createDataFrame([(10, f"zero {PASSAGE} thirteen", 1), (11, PASSAGE, 1), (11, PASSAGE, 1), (12, None, 1), (13, "short", 1)], "item_id bigint, item_text string, doc_id int")
    return documents, items


def test_found(spark):
    documents, items = frames(spark)
    got = sorted((r.doc_id or 0, r.item_id) for r in L.leaks(documents, items).collect())
    assert got == [(d, i) for d in (0, 1) for i in (10, 11)][:2] + [(1, 10), (1, 10), (1, 11), (1, 11), (2, 10), (2, 11), (6, 10), (6, 11)]
    assert L.leaks(documents.where("false"), items).count() == 0
    assert L.leaks(documents, items.where("false")).count() == 0


def test_removal(spark):
    documents, items = frames(spark)
    got = {r.doc_id: r for r in L.without_leaks(documents, items, max_coverage=0.9).collect()}
    assert got[1].verdict == "cut" and got[1].text == "Before. ! after"
    assert got[2].verdict == "dropped" and got[2].text is None
    assert got[3].verdict == got[4].verdict == got[5].verdict == "clean"
    assert got[6].text == "filler " * 50_000


def test_any_number_of_blocks_and_parts_gives_the_same(spark):
    documents, items = frames(spark)
    long = " ".join(f"w{k}" for k in range(200))
    documents = documents.unionByName(spark.createDataFrame([(7, f"x {long} y", "c"), (8, "w5 " + " ".join(long.split()[80:130]), "c")], documents.schema))
    items = items.unionByName(spark.createDataFrame([(20, long, 1)], items.schema))
    whole = sorted((r.doc_id, r.item_id, r.words, str(r.spans)) for r in L.leaks(documents.where("doc_id > 0"), items).collect())
    assert (7, 20, 200) in [w[:3] for w in whole] and (8, 20, 50) in [w[:3] for w in whole]
    assert L.segments(items, 12, 20).select("block").distinct().count() > 1
    assert sorted((r.doc_id, r.item_id, r.words, str(r.spans)) for r in L.leaks(documents.where("doc_id > 0"), items, block_words=20).collect()) == whole
    kept = sorted((r.doc_id or 0, r.verdict, r.text or "") for r in L.without_leaks(documents, items).collect())
    assert sorted((r.doc_id or 0, r.verdict, r.text or "") for r in L.without_leaks(documents, items, block_words=20).collect()) == kept
    rows = documents.where("doc_id > 0").selectExpr("doc_id AS row", "doc_id", "text").where("text IS NOT NULL")
    one = sorted(tuple(r) for r in L.spans(rows, items).collect())
    assert sorted(tuple(r) for r in L.spans(rows, items, part_words=30).collect()) == one


def test_letters_whose_lower_case_is_longer(spark):
    documents = spark.createDataFrame([(1, "İstanbul İ " * 30 + PASSAGE + " İstanbul")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, PASSAGE)], "item_id bigint, item_text string")
    row = L.without_leaks(documents, items).first()
    assert row.verdict == "cut" and row.text == "İstanbul İ " * 30 + " İstanbul" and row.removed_words == 12


def test_spans_against_brute_force(spark):
    """Random texts over few words, so that runs touch, overlap and come again; blocks and parts of a few words."""
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(6)]
    texts = {k: rng.choices([*vocabulary, "other", "x"], k=rng.randint(0, 60)) for k in range(80)}
    held = {100 + k: rng.choices(vocabulary, k=rng.randint(1, 30)) for k in range(12)}
    expected = set()
    for d, words in texts.items():
        for i, item in held.items():
            runs = {tuple(item[k : k + 4]) for k in range(len(item) - 3)}
            covered = {at for k in range(len(words) - 3) if tuple(words[k : k + 4]) in runs for at in range(k, k + 4)}
            if covered:
                expected.add((d, i, len(covered)))
    documents = spark.createDataFrame([(d, "  ".join(w).upper()) for d, w in texts.items()], "doc_id bigint, text string")
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in held.items()], "item_id bigint, item_text string")
    for blocks in (10_000, 25):
        got = {(r.doc_id, r.item_id, r.words) for r in L.leaks(documents, items, least=4, block_words=blocks).collect()}
        assert got == expected
