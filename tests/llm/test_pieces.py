"""Problem 3: the pieces of a text are within the limit, overlap exactly and give the text back."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import pieces as P

WORDS = ["alpha", "beta.", "gamma,", "delta!", "epsilon?", "zeta;", "x" * 40, "\n", "\n\n", "\n  \n", "é", "日本", " "]


def whole(text: str, way: list, overlap: int) -> str:
    return text[way[0][0] : way[0][1]] + "".join(text[a + overlap : b] for a, b, _ in way[1:])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=120), st.integers(1, 90), st.integers(-3, 100))
def test_round_trip(parts, limit, overlap):
    text = " ".join(parts)
    way = P.cut(text, limit, overlap)
    shared = min(max(0, overlap), limit - 1)
    assert whole(text, way, shared) == text
    assert all(0 < b - a <= limit for a, b, _ in way) or text == ""
    assert all(a2 == b1 - shared for (_, b1, _), (a2, _, _) in zip(way, way[1:]))
    assert all(b1 < b2 for (_, b1, _), (_, b2, _) in zip(way, way[1:]))


def brute(text: str, limit: int, overlap: int) -> float:
    """The least cost over all ways through every boundary of the text, by plain recursion; characters are a last resort."""
    room = limit - overlap
    kinds: dict[int, str] = {}
    for kind, pattern in P.KINDS:
        for m in pattern.finditer(text):
            kinds.setdefault(m.end(), kind)
    cuts = sorted(k for k in kinds if 0 < k < len(text))
    for a, b in zip([0, *cuts], [*cuts, len(text)]):
        if b - a > 2 * max(1, room // 2):
            kinds |= {k: "character" for k in range(a + max(1, room // 2), b - max(1, room // 2), max(1, room // 2))}
    places = [(0, 0.0), *((k, P.PENALTY[kinds[k]]) for k in sorted(kinds) if 0 < k < len(text)), (len(text), 0.0)]
    count = -(-(len(text) - overlap) // room)
    mean = (len(text) + (count - 1) * overlap) / count
    best = {0: 0.0}
    for j in range(1, len(places)):
        options = []
        for i in range(j):
            if i in best and (i == 0 or places[i][0] > overlap):
                size = places[j][0] - (places[i][0] - overlap if i else 0)
                if size <= limit:
                    options.append(best[i] + P.IMBALANCE * ((size - mean) / limit) ** 2 + places[j][1])
        if options:
            best[j] = min(options)
    return best[len(places) - 1]


def cost(text: str, way: list, limit: int, overlap: int) -> float:
    count = -(-(len(text) - overlap) // (limit - overlap))
    mean = (len(text) + (count - 1) * overlap) / count
    return sum(P.IMBALANCE * ((b - a - mean) / limit) ** 2 + P.PENALTY.get(kind, 0.0) for a, b, kind in way)


def test_least_cost():
    rng = random.Random(5)
    for _ in range(150):
        text = " ".join(rng.choices(WORDS, k=rng.randint(5, 60)))
        limit = rng.randint(20, 80)
        overlap = rng.choice([0, 0, 5, 10])
        if len(text) > limit:
            way = P.cut(text, limit, overlap)
            assert cost(text, way, limit, overlap) == pytest.approx(brute(text, limit, overlap))


def test_cuts_at_paragraphs_where_possible():
    text = "\n\n".join(["A sentence here. Another one."] * 8)
    assert {kind for *_, kind in P.cut(text, 70, 0)} == {"paragraph", "end"}


def test_boundary():
    assert P.boundary("aa. bb.\n \ncc", 8) == "paragraph"
    assert P.boundary("aa. bb.\n\ncc", 4) == "sentence"
    assert P.boundary("aaaaaa bb", 4) == "none"
    assert P.boundary("a.bbbb", 4) == "none"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=60), st.integers(1, 60))
def test_boundary_against_its_definition(parts, limit):
    """What the programme finds is what the lengths of paragraphs and sentences say."""
    text = " ".join(parts)
    paragraphs = [p.strip() for p in P.BLANK_LINES.split(text)]
    sentences = [s for p in paragraphs for s in P.SENTENCE_END.split(p)]
    expected = "paragraph" if all(len(p) <= limit for p in paragraphs) else "sentence" if all(len(s) <= limit for s in sentences) else "none"
    assert P.boundary(text, limit) == expected


def test_very_long_text():
    text = "x" * 300_000 + " word. " * 20_000
    way = P.cut(text, 4_000, 200)
    assert whole(text, way, 200) == text


def test_operator(spark):
    chunks = spark.createDataFrame(
        [(1, "one two three. four five", "a", "t", "clash", 9), (1, "one two three. four five", "a", "t", "clash", 9), (2, None, "a", "t", "", 9), (3, "", "a", "t", "", 9), (4, "long text without limit", None, None, "", 9), (None, "some words to cut", " ", "t", "", 9), (5, "short", "a", "t", "", 9)],
        "row_no bigint, text string, section_path string, chunk_type string, boundary string, max_chars int",
    )
    limits = spark.createDataFrame([("t", 10, 2), ("t", 12, 0), ("u", None, None), (None, 3, 1)], "chunk_type string, max_chars int, overlap_chars int")
    got = P.pieces(chunks, limits).collect()
    assert {r.row_no for r in got} == {1, None}
    assert all(len(r.text) <= 10 for r in got)
    assert len([r for r in got if r.row_no == 1]) % 2 == 0
    assert {r.section_path[:2] for r in got if r.row_no is None} == {"(p"}
    assert len({r.section_path for r in got if r.row_no == 1}) == max(r.pieces for r in got if r.row_no == 1)
    assert P.pieces(chunks.where("false"), limits).count() == 0
    assert P.pieces(chunks, limits.where("false")).count() == 0
