"""Laid-out documents made of a few lines, and trails against a stack."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quern.operators import layout, publications

SCHEMA = "doc_id string, line_no bigint, text string, page int, size double, bold boolean, y double"


def lines(spark, rows, doc="D"):
    """rows: (text, page, size, bold)."""
    return spark.createDataFrame([(doc, k, t, p, float(s), b, 0.0) for k, (t, p, s, b) in enumerate(rows)], SCHEMA)


def body(text, page=1, size=10, bold=False):
    return (text, page, size, bold)


@pytest.mark.parametrize(
    "text,size,bold,level",
    [
        ("1 Introduction", 10, False, 1), ("2.3.1 Scope of work", 10, False, 3), ("1 Information is categorized", 8, False, None), ("CHAPTER THREE", 10, False, 1), ("TASK P-1", 10, False, 3), ("Appendix B: Terms", 10, False, 1), ("A.1 Lettered", 10, False, 2), ("Display Title", 12, False, 2),
        ("Bold line", 10, True, 3), ("UPPER LINE", 10, False, 3), ("Plain line", 10, False, None), ("Ends like prose.", 14, True, None), ("- bullet", 14, True, None), ("ends with the", 14, True, None), ("trailing,", 14, True, None), ("A", 30, True, None), ("", 14, True, None), ("x" * 161, 14, True, None),
    ],
)
def test_heading_level(spark, text, size, bold, level):
    df = spark.createDataFrame([(text, float(size), bold)], "t string, s double, b boolean")
    assert df.select(layout.heading_level(F.col("t"), F.col("s"), F.col("b"), F.lit(10.0)).alias("l")).first().l == level


def test_body_size_ties_and_defaults(spark):
    assert layout.body_font_size(lines(spark, [body("abcd", size=12), body("abc", size=9), body("a", size=9)])).first().body_size == 12
    assert layout.body_font_size(lines(spark, [])).count() == 0


def test_furniture(spark):
    rows = []
    for page in range(1, 7):
        rows += [(f"Running Header page {page}", page, 10, False), (f"{page}", page, 10, False), (f"text on page {page} " + "abcdef"[page - 1] * 9, page, 10, False), ("______", page, 10, False)]
    rows += [("Chapter ........ 7", 6, 10, False), ("This publication is available free of charge", 6, 10, False)]
    assert [r.text[:12] for r in layout.without_furniture(lines(spark, rows)).orderBy("line_no").collect()] == ["text on page"] * 6


def test_contents_pages(spark):
    rows = [(f"Section number {w} {k}", 2, 10, False) for k, w in enumerate("abcdef", 3)] + [("x", 30, 10, False)]
    assert [(r.page) for r in layout.contents_pages(lines(spark, rows)).collect()] == [2]


def test_trails_against_a_stack(spark):
    rng = random.Random(6)
    rows, expected = [], []
    for d in range(30):
        stack: list[tuple[int, str]] = []
        for k in range(40):
            level = rng.choice([1, 1, 2, 2, 3, 4, None])
            text = "body text here" if level is None else ".".join(["1"] * level) + f" Head w{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10]}"
            rows.append((f"D{d}", k, text, k + 1, 10.0, False, 0.0))
            if level:
                while stack and stack[-1][0] >= level:
                    stack.pop()
                expected.append((f"D{d}", k, [h for _, h in stack]))
                stack.append((level, text))
    df = spark.createDataFrame(rows, SCHEMA)
    got = [(r.doc_id, r.line_no, r.trail) for r in layout.sectioned(df).where("level IS NOT NULL").collect()]
    assert sorted(got) == sorted(expected)


def test_definitions(spark):
    rows = [body("skipped before"), body("Access: The right"), body("to enter"), body("Availability – Being (there)"), body("not a term: lower"), body("Agency  Name: Any body")]
    got = layout.extract_definitions(lines(spark, rows)).orderBy("first_line").collect()
    assert [(r.term, r.text) for r in got] == [("Access", "Access: The right to enter"), ("Availability", "Availability: Being (there) not a term: lower"), ("Agency Name", "Agency Name: Any body")]


def test_terms_told_by_type(spark):
    rows = [("GLOSSARY", 5, 16, False), ("authorizing official", 5, 10, True), ("designated representative", 5, 10, True), ("A person who acts for another.", 5, 10, False), ("APPENDIX B", 5, 10, False), ("short tail", 5, 10, False), ("boundary", 5, 10, False), ("[SP 800-1,", 5, 8, False), ("What is inside.", 5, 10, False), ("REFERENCES", 7, 16, False), ("after", 7, 10, True)]
    df = lines(spark, rows)
    spans = layout.appendix_spans(df, "glossary")
    assert [(r["first"], r["last"]) for r in spans.collect()] == [(5, 6)]
    got = [(r.term, r.text) for r in layout.term_definitions(df, spans).orderBy("first_line").collect()]
    assert got == [("authorizing official designated representative", "authorizing official designated representative: A person who acts for another."), ("short tail boundary", "short tail boundary: [SP 800-1, What is inside.")]


def test_blocks(spark):
    rows = [body("CHAPTER 1"), body("TASK P-1 First task"), body("does it"), body("CHAPTER 2 ends it"), body("lost"), body("TASK P-1"), body("TASK P-2 Second"), body("more lines of the second task")]
    marked = layout.sectioned(lines(spark, rows))
    blocks = layout.extract_blocks(marked, r"^TASK\s+([PC]-\d+)\b", r"(?i)^CHAPTER\s")
    kept, stubs = layout.keep_longest(blocks)
    assert sorted((r.key, r.lines) for r in kept.collect()) == [("P-1", ["TASK P-1 First task", "does it"]), ("P-2", ["TASK P-2 Second", "more lines of the second task"])]
    assert [r.key for r in stubs.collect()] == ["P-1"]


def test_equal_blocks_are_logged_once(spark):
    marked = layout.sectioned(lines(spark, [body("TASK P-1 same"), body("x"), body("TASK P-1 same"), body("x")]))
    kept, stubs = layout.keep_longest(layout.extract_blocks(marked, r"^TASK\s+(P-\d+)\b"))
    assert kept.count() == stubs.count() == 1


def test_join_lines(spark):
    df = spark.createDataFrame([("D", 1, ["an inte-", "grated risk-", "based plan re-", "view and Auto-", "Mate"])], "doc_id string, block bigint, lines array<string>")
    words = spark.createDataFrame([("D", "integrated"), ("D", "risk-based")], "doc_id string, word string")
    got = layout.needed_words(df, words).select(layout.join_lines(F.col("lines"), F.col("known")).alias("t")).first().t
    assert got == "an integrated risk-based plan review and Auto- Mate"
    assert df.select(layout.join_lines(F.col("lines")).alias("t")).first().t == "an inte- grated risk- based plan re- view and Auto- Mate"


def test_grid(spark):
    grid = [["", None, "LOW", "MODERATE", "HIGH"], ["Confidentiality - Keeping  it", " ", "a", " b ", "c"], ["INTEGRITY", "", "d", "e", "f"], ["Availability", "", "g", "h"]]
    df = spark.createDataFrame([(grid,), (grid[:3],)], "g array<array<string>>").select(layout.transcribe_impact_table(layout.trim_grid(F.col("g"))).alias("t"))
    full, part = [r.t for r in df.collect()]
    assert full.split("\n") == ["Confidentiality (definition): Keeping it", "Confidentiality / LOW: a", "Confidentiality / MODERATE: b", "Confidentiality / HIGH: c", "Integrity / LOW: d", "Integrity / MODERATE: e", "Integrity / HIGH: f", "Availability / LOW: g", "Availability / MODERATE: h"]
    assert part is None


def one_after_the_other(slugs):
    """Ids as a sequential reader gives them."""
    seen, out = set(), []
    for natural in slugs:
        k = 2
        found = natural
        while found in seen:
            found, k = f"{natural}-{k}", k + 1
        seen.add(found)
        out.append(found)
    return out


def given_ids(spark, groups):
    rows = [(f"D{g}", "section", slug, k) for g, slugs in enumerate(groups) for k, slug in enumerate(slugs)]
    got = layout.with_ids(spark.createDataFrame(rows, "doc_id string, chunk_type string, slug string, seq bigint")).orderBy("doc_id", "seq").collect()
    out: dict = {}
    for r in got:
        out.setdefault(r.doc_id, []).append(r.id.split("/", 2)[2])
    return [out[f"D{g}"] for g in range(len(groups))]


def test_ids(spark):
    known = ["Intro 2", "Intro", "Intro", "Intro", "intro-2", "intro 2"]
    assert given_ids(spark, [known]) == [["intro-2", "intro", "intro-3", "intro-4", "intro-2-2", "intro-2-3"]]
    rng = random.Random(9)
    groups = [[rng.choice(["a", "a", "a", "a-2", "a-3", "a-4", "a-2-2", "a-2-3", "a-2-2-2", "a-1", "a-02", "b", "b-7", "b"]) for _ in range(rng.randint(1, 25))] for _ in range(60)]
    assert given_ids(spark, groups) == [one_after_the_other(g) for g in groups]


def test_many_repeats_of_one_id(spark):
    slugs = ["x"] * 400 + ["x-5"] * 3 + ["x-700"] + ["x"] * 400 + ["x-700"]
    assert given_ids(spark, [slugs]) == [one_after_the_other(slugs)]


def publication():
    front = [("Signature Block", 1, 14, False), ("many names and titles of people", 1, 10, False)]
    main = [("1 Introduction", 2, 10, True), ("This part says what the publication is for, at some length.", 2, 10, False), ("1.1 Tiny", 3, 10, True), ("x", 3, 10, False), ("Glossary", 4, 14, False), ("Access: The right to enter a place or to use a thing.", 4, 10, False), ("Bad: Xy", 4, 10, False)]
    return front + main


def test_publications(spark):
    tasks = [("1 Chapter one of the work", 1, 10, True), ("TASK P-1 " + "Prepare the people and the plans. " * 8, 1, 10, False), ("TASK P-1", 2, 10, False), ("2 Another part of it", 3, 10, True), ("Words that make up the body of the other part.", 3, 10, False)]
    df = lines(spark, publication(), "ANY").unionByName(lines(spark, tasks, "SP-800-37r2"))
    rows, rejected = publications.parse_publications(df)
    got = {(r.doc_id, r.chunk_type, r.slug): r for r in rows.collect()}
    assert got["ANY", "section", "1 Introduction"].text.startswith("1 Introduction\n\nThis part")
    assert got["ANY", "definition", "Access"].section_path.endswith("Glossary > Access")
    assert got["SP-800-37r2", "task", "P-1"].section_path == "1 Chapter one of the work > TASK P-1"
    rules = {(r.doc_id, r.rule) for r in rejected.collect()}
    assert {("ANY", "front_matter"), ("ANY", "section_too_short"), ("ANY", "definition_too_short"), ("SP-800-37r2", "duplicate_task_stub"), ("SP-800-37r2", "glossary_not_found")} <= rules
    none, nothing = publications.parse_publications(lines(spark, []))
    assert none.count() == nothing.count() == 0
