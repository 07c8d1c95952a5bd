"""Problem 1: the models on texts spoilt here, against what was spoilt."""

from __future__ import annotations

import random

import pytest

from quern.llm import scans as S

SENTENCES = [
    "The privacy analyst verifies the monitoring strategy when a significant change affects the operating environment.",
    "A summary of the recovery objective accompanies the well-known continuity exercise before any production data leaves.",
    "Each on-call check of the training records takes about eleven minutes and needs only one account holder.",
    "Responsibility for the maintenance schedule remains with the information steward until the evidence is complete.",
    "Nobody at Kettleby could say when the security architect last had to review the supplier agreement.",
]


def clean_rows(n: int = 250):
    rng = random.Random(2)
    out = []
    for k in range(n):
        text = "\n\n".join(" ".join(rng.choices(SENTENCES, k=rng.randint(2, 4))) for _ in range(rng.randint(1, 3)))
        out.append((k, text, f"AB-{k % 20}", "Handbook for Remote Repair", "2 Alarm Drills > 2.1 Remote Repair Roles", "clash"))
    return out


def spoilt_rows(n: int = 40):
    """(row, expected faults): wrapped lines with a page number and header, divided words and misread letters."""
    rng = random.Random(3)
    rows, faults = [], set()
    for k in range(n):
        row_no = 10_000 + k
        words = " ".join(rng.choices(SENTENCES, k=8)).split()
        lines, line = [], ""
        for w in words:
            if len(line) + len(w) > 55 and len(w) > 7 and w.isalpha() and rng.random() < 0.5:
                cut = rng.randint(2, len(w) - 2)
                lines.append((f"{line} {w[:cut]}".strip() + rng.choice("-¬­‐"), "broken_word"))
                line = w[cut:]
            elif len(line) + len(w) > 55:
                lines.append((line, None))
                line = w
            else:
                line = f"{line} {w}".strip()
        lines.append((line, None))
        out = []
        for i, (text, fault) in enumerate(lines):
            if i and i % 4 == 0:
                for furniture in (f"Page {3 + i // 4}", f"Remote Repair Roles | AB-{k % 20}"):
                    out.append(furniture)
                    faults.add((row_no, len(out), "furniture"))
            if rng.random() < 0.3 and "monitoring" in text.split():
                text = text.replace("monitoring", "m0nitoring")
                faults.add((row_no, len(out) + 1, "wrong_char"))
            out.append(text)
            if fault:
                faults.add((row_no, len(out), fault))
        rows.append((row_no, "\n".join(out), f"AB-{k % 20}", "Handbook for Remote Repair", "2 Alarm Drills > 2.1 Remote Repair Roles", "clash"))
    return rows, faults


SCHEMA = "row_no bigint, text string, doc_id string, doc_title string, section_path string, fault string"


@pytest.fixture(scope="module")
def table(spark):
    rows, faults = spoilt_rows()
    odd = [(20_000, None, None, None, None, None), (20_001, "", None, None, None, None), (20_002, " \n \n", None, None, None, None), (None, SENTENCES[0], None, None, None, None), (20_003, (SENTENCES[0] + "\n") * 2_000, None, None, None, None)]
    # A list of short items and hyphens that stay are harmless.
    odd += [(20_004, "\n".join(["SI-6", "door codes", "AU-14", "mail rules", "SI-6", "door codes", "RA-2"] * 4), "AB-1", None, None, None), (20_005, f"{SENTENCES[2][:8]}on-\ncall check of the training records.", "AB-1", None, None, None)]
    return spark.createDataFrame(clean_rows() + rows + odd, SCHEMA), faults


def test_found(table):
    df, expected = table
    got = {(r.row_no, r.line_no, r.fault) for r in S.faults(df).collect()}
    assert len(got & expected) > 0.97 * len(expected)
    assert len(got - expected) < 0.03 * len(expected)
    assert not {g for g in got if g[0] is None or g[0] >= 20_000 or g[0] < 10_000}


def test_repaired(table):
    df, _ = table
    got = {r.row_no: r for r in S.repaired(df).collect()}
    rows, _ = spoilt_rows()
    vocabulary = {w for s in SENTENCES for w in s.split()}
    wrong = total = 0
    for row_no, *_ in rows:
        words = got[row_no].text.split()
        total += len(words)
        wrong += sum(w not in vocabulary for w in words)
        assert got[row_no].faults > 0
    assert wrong < 0.01 * total
    for row_no, text, *_ in clean_rows():
        assert got[row_no].text == text and got[row_no].faults == 0
    assert got[20_001].text == ""


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert S.faults(df).count() == 0 and S.repaired(df).count() == 0


def test_repeated_rows(table):
    df, _ = table
    twice = df.where("row_no >= 10000 AND row_no < 20000")
    both = df.unionByName(twice)
    assert S.faults(both).where("row_no < 20000").count() == 2 * S.faults(both).where("row_no < 20000").distinct().count()


def test_editor_tells_words_from_misread_ones():
    words = {w.strip(".").lower() for s in SENTENCES for w in s.split()}
    lexicon = S.Lexicon([(w, 500, 10) for w in words] + [("m0nitoring", 2, 2), ("korvale", 40, 1)])
    editor = S.Editor(lexicon)
    editor.train()
    assert editor.correct("rnonitoring") == "monitoring"
    assert editor.correct("5teward") == "steward"
    assert editor.correct("objecfive") == "objective"
    assert editor.correct("zyzzyva") is None
    assert editor.correct("x" * 10_000) is None


def test_lexicon_is_bounded(spark):
    texts = spark.createDataFrame([(" ".join(f"w{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10]}" for k in range(100)) + " often" * 900,)], "text string")
    assert set(S.lexicon(texts, least_share=0.5).count) == {"often"}


def test_rare_words_count_exactly(spark):
    rows = clean_rows() + spoilt_rows()[0]
    rows += [(30_000 + k, f"{SENTENCES[k % 5]} The zephyranthes stands in the hall.", "AB-1", None, None, None) for k in range(3)]
    rows += [(30_100 + k, f"{SENTENCES[k % 5]} The marine store is closed.", "AB-1", None, None, None) for k in range(15)]
    rows += [(30_200 + k, f"{SENTENCES[0]} The m0nitoring of the rnarine store goes on.", "AB-1", None, None, None) for k in range(8)]
    rows += [(30_300, f"{SENTENCES[0]} The zephyranth3s was here.", "AB-1", None, None, None), (30_301, "The zephyr-\nanthes stands in the hall of\nthe well-known zephyran-\nth3s.", "AB-1", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    share = 8e-4
    models, rare, bound = S.prepare(df.select("row_no", "text", "doc_id", "doc_title", "section_path"), share)
    assert {"zephyranthes", "marine", "rnarine"} <= {r.word for r in rare.collect()} and bound > 15
    repairer = S.Repairer(S.Lexicon([tuple(r) for r in S.word_counts(df).collect()]), *models[1:])
    expected = sorted((r[0], line, fault) for r in rows for line, fault in repairer.analyse(*r[1:5], repair=False)[0])
    got = sorted(tuple(r) for r in S.faults(df, share).collect())
    assert got == expected
    assert (30_300, 1, "wrong_char") in got and (30_301, 1, "broken_word") in got
    better = {r.row_no: r.text for r in S.repaired(df, share).collect()}
    assert better == {r[0]: repairer.analyse(*r[1:5], repair=True)[1] for r in rows}
    assert "zephyranthes was here" in better[30_300]
    # 15 occurrences are not 20 times 8.
    assert "monitoring of the rnarine store" in better[30_200]
    small = S.Bitmaps(rare, 32)
    assert all(small.may_hold(S._TRUSTED, r.word) or small.may_hold(S._OTHER, r.word) for r in rare.collect())
