"""Problem 4: what is residue, and what only looks like it."""

from __future__ import annotations

import pytest

from quern.llm import residue as R

PROSE = "The owner reviews the plan every year. "

RESIDUE = {
    "placeholder": ["Dear {{ name }}, welcome.", "At [INSERT DATE] the plan", "Ask <<owner>> first.", "The ${SITE} team", "Run %%UNIT%% now", "signed @@OWNER@@ today", "by <Agency Name> on", "as of XX-REPORT_DATE-XX the", "the {% if x %} part", "write to &lt;contact email&gt; soon", "the [site TBD] log", "(name of unit to be supplied) agrees", "reviewed {2} times", "in __FILL_IN__ form", "$(owner) signs", "[Enter unit here]", "a <%= doc.x %> b"],
    "filler": ["Lorem ipsum dolor sit amet.", "Text goes here. Text goes here.", "asdf qwer foo bla asdf hjkl", "Dummy copy for layout only.", "Sed vestibus magnatis ametra. Portico tamenus fringila consequa.", "Replace this paragraph with your own."],
    "error_page": ["404 - Not Found", "Sorry, the page could not be opened.", "Error 503: try again.", "Access denied.", "Your session has expired.", "Traceback (most recent call last): x", "This service is down for planned upkeep.", "Oops, that file failed to load."],
    "script_notice": ["Please enable JavaScript to view this page.", "Without scripts you cannot read the document!", "JS must be on to continue.", "This viewer needs scripts; switch them on.", "Your browser does not run active content."],
}
HARMLESS = [
    "Complete it within [Assignment: organization-defined frequency].", "Use [Selection (one or more): a bag; a box].", "The placeholder account was removed.", "Values below <5 % and above >95 % are rare.", "The job reads its path from $HOME and stops.",
    "Braces { } enclose a set, and [see annex C] is a pointer.", "A visitor who meets an error page reports the code, such as 404 or 503, to the desk.", "Scripts, including JavaScript, stay disabled in the browser on the jump host unless the manager agrees.",
    "If access is denied at the gate, the log shows it.", "Sample text for the drill is kept in the archive.", "Page 3 of the form stays blank.", "```\nHello {{ name }}\n```", "In the template language a variable is written as {{ name }} in braces.",
    "See [1] and (2020) for more.", "- item\n- item\n- item", "", "   \n ",
]


@pytest.mark.parametrize("kind,text", [(k, t) for k, texts in RESIDUE.items() for t in texts])
def test_residue(kind, text):
    assert kind in dict(R.judge(text)), R.judge(text)
    assert kind in dict(R.judge(f"{PROSE}\n\n{text}\n\n{PROSE}"))


@pytest.mark.parametrize("text", HARMLESS)
def test_harmless(text):
    assert R.judge(text) == []
    assert R.judge(PROSE + text) == []


#: Texts that teach, explain or tell of such things, none of them like the tables.
SPOKEN_OF = [
    "This tutorial explains template syntax.\nHello {{ name }}\nTotal: {{ total }}\nBye {{ user }}\nThe engine replaces each placeholder by its value.",
    "Jinja lesson: write {{ x }} where the value of x shall stand.",
    'Lorem ipsum has been the usual dummy text of printers since the 1500s. It comes from a work of Cicero, and "Lorem ipsum dolor sit amet" are its first words. Lorem ipsum dolor sit amet. Later printers changed it until the words had lost their sense.',
    "The HTTP 404 status means that the server did not find the page.",
    "Python raises KeyError: when a key is missing.",
    "Please sign in again at the front gate.",
    "When a page is not found, the crawler marks the address and goes on.",
    "The auditor checks whether JavaScript is disabled on the kiosks.",
]
#: The same kinds of residue in other languages.
FOREIGN = [
    ("error_page", "Die Seite konnte nicht gefunden werden."), ("error_page", "La página que busca no se encontró."), ("error_page", "Fehler 404: Seite nicht gefunden"), ("error_page", "Votre session a expiré."),
    ("script_notice", "Bitte aktivieren Sie JavaScript, um diese Seite zu sehen."), ("script_notice", "Por favor, active JavaScript para ver esta página."), ("script_notice", "Esta página requiere JavaScript."),
]


@pytest.mark.parametrize("text", SPOKEN_OF)
def test_what_is_only_spoken_of(text):
    assert R.judge(text) == []
    assert R.judge(PROSE + text + " " + PROSE) == []


@pytest.mark.parametrize("kind,text", FOREIGN)
def test_other_languages(kind, text):
    assert kind in dict(R.judge(text))


def test_density_tells_a_form_from_a_lesson():
    form = "Dear {{ name }}, your order {{ number }} leaves on {{ date }}."
    lesson = "Template syntax: a variable such as {{ name }} is written in braces; an expression like {{ a + b }} renders its value. " + form
    assert R.judge(form) and not R.judge(lesson)


def test_wrapped_and_upper_case():
    assert dict(R.judge("PLEASE ENABLE\nJAVASCRIPT TO\nVIEW THIS PAGE."))
    assert dict(R.judge("Your session\nhas run out."))


def test_whole_text_is_read():
    assert dict(R.judge(PROSE * 5_000 + "At [INSERT DATE] it ends."))


def test_operator(spark):
    rows = [(1, "Hello {{ name }}", "x"), (1, "Hello {{ name }}", "x"), (2, None, None), (3, "", "y"), (4, PROSE, "z"), (None, "Access denied.", "n")]
    chunks = spark.createDataFrame(rows, "row_no bigint, text string, kinds string")
    got = R.residue(chunks).collect()
    assert sorted(((r.row_no or 0), r.kinds) for r in got) == [(0, ["error_page"]), (1, ["placeholder"]), (1, ["placeholder"])]
    # Each row is judged for itself, so residue goes whether its key is null or not.
    assert sorted(r.row_no or 0 for r in R.without_residue(chunks).collect()) == [2, 3, 4]
    assert R.without_residue(chunks).columns == chunks.columns
    assert R.residue(chunks.where("false")).count() == 0


@pytest.mark.parametrize("tag", ["pre", "code", "PRE"])
def test_code_blocks_of_any_length_are_no_residue(tag):
    listing = "echo ${NAME} {{x}} <% y %>\n" * 5_000
    assert R.judge(f"{PROSE}<{tag} class='a'>{listing}</{tag}> {PROSE}") == []
    assert R.judge(f"{PROSE}<{tag}>{listing}</{tag}> {PROSE} Ask ${{OWNER}} first.") == [("placeholder", "dollar braces")]
    # Not closed, so it is no block; and openers without an end cost no more than their length.
    assert R.judge(f"{PROSE}<{tag}>{PROSE} Ask ${{OWNER}} first.") == [("placeholder", "dollar braces")]
    assert R._without_code(f"<{tag}>" * 200_000 + "`a`") == f"<{tag}>" * 200_000 + " "
