"""Text expressions, one crafted value each."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quern.functions import text as T


def value(spark, function, *arguments):
    names = [f"c{i}" for i in range(len(arguments))]
    df = spark.createDataFrame([arguments], ", ".join(f"{n} string" for n in names))
    return df.select(function(*[F.col(n) for n in names]).alias("v")).first().v


@pytest.mark.parametrize(
    "raw,normal",
    [
        ("ﬁ ﬄ “a” ‘b’ – — − …", "fi ffl \"a\" 'b' - - - ..."), ("a\tb\x07c\r\nd", "a bc\nd"), ("a\rb", "ab"), ("a  b   c", "a b c"), ("a \n  b", "a\nb"), ("a\n\n\n\nb", "a\n\nb"), ("  　a ", "a"), ("a​b c", "ab c"), ("", ""), (None, None),
        ("x" * 100_000, "x" * 100_000),
    ],
)
def test_normalize_text(spark, raw, normal):
    assert value(spark, T.normalize_text, raw) == normal


@pytest.mark.parametrize("raw,slug", [("AC-2.3 Account Management", "ac-2.3-account-management"), ("  Café — Ünïcode  ", "cafe-unicode"), ("ﬁle ½", "file-12"), ("•", ""), ("日本", ""), ("A  &  B", "a-b"), ("GOVERN 1.1", "govern-1.1"), ("Ⅷ ㎏ ⑩ 𝐀bc Ａ ﷺ", "viii-kg-10-abc-a"), ("Ω ǆ ²", "dz-2")])
def test_slugify(spark, raw, slug):
    assert value(spark, T.slugify, raw) == slug


def test_make_id(spark):
    assert value(spark, T.make_id, "SP-1", "section", "3.2 Scope") == "SP-1/section/3.2-scope"
    with pytest.raises(Exception, match="unknown chunk_type"):
        value(spark, T.make_id, "SP-1", "chapter", "x")
    with pytest.raises(Exception, match="no slug"):
        value(spark, T.make_id, "SP-1", "section", "•")


@pytest.mark.parametrize("raw,known", [("ac-2", True), ("ac-2.3", True), ("sr-12", True), ("AC-2", False), ("ha-25", False), ("ac2", False), ("ac-2\n", False), ("ac-2.3.4", False), ("xac-2", False)])
def test_control_ids(spark, raw, known):
    assert value(spark, T.is_control_id, raw) is known


@pytest.mark.parametrize("raw,left", [("APPENDIX B PAGE B-2 Text", "Text"), ("chapter three\n\nbody", "body"), ("CHAPTER 1 PAGE 9\nText", "Text"), ("The appendix B", "The appendix B"), ("APPENDIX B", "APPENDIX B")])
def test_strip_running_header(spark, raw, left):
    assert value(spark, T.strip_running_header, raw) == left


@pytest.mark.parametrize(
    "raw,reference",
    [("[SP 800-53] Guidance follows here", False), ("[NISTIR 7298] Glossary (2013) available at", True), ("Ross, R. (2018) Title", True), ('Smith, J. A. "Title"', True), ("Plain text", False), ("[X] " + "y" * 400 + " https://a.example", False)],
)
def test_reference_entries(spark, raw, reference):
    assert value(spark, T.is_reference_entry, raw) is reference


def test_html_to_text(spark):
    html = "<p>a</p><SCRIPT>x<y</SCRIPT><style>\n.b{}\n</style>&amp;lt; b&nbsp;c &quot;d&#39;"
    assert value(spark, T.html_to_text, html) == "a < b c \"d'"


def test_links(spark):
    html = """<a href="/a/SP.800-60v1r1.pdf">1</a><a href='other.pdf'>2</a><a href="https://nvlpubs.nist.gov/z.PDF">3</a><a href="http://x.example/80060v1r1.pdf">4</a><a href="../up/80060v1r1.pdf">5</a>"""
    got = value(spark, lambda h, b, d: F.transform(T.pdf_links(h, b, d), lambda x: x["url"]), html, "https://csrc.example/pubs/sp/page.html", "SP-800-60v1r1")
    assert got == ["https://csrc.example/a/SP.800-60v1r1.pdf", "https://csrc.example/pubs/up/80060v1r1.pdf", "https://nvlpubs.nist.gov/z.PDF"]


@pytest.mark.parametrize("href,url", [("../../../../../../x.pdf", "https://h.example/x.pdf"), ("./a/./../b.pdf", "https://h.example/1/2/3/4/5/b.pdf"), ("/q/../r.pdf", "https://h.example/r.pdf"), ("../../6/7/../8.pdf", "https://h.example/1/2/3/6/8.pdf"), ("//o.example/s.pdf", "https://o.example/s.pdf")])
def test_parent_folders(spark, href, url):
    assert value(spark, lambda b, h: T._resolved(b, h), "https://h.example/1/2/3/4/5/page.html?q#f", href) == url


def test_addresses(spark):
    old = value(spark, T.alternate_urls, "https://nvlpubs.nist.gov/nistpubs/SpecialPublications/NIST.SP.800-60v1.pdf")
    assert [u.rsplit("/", 1)[1] for u in old] == ["nistspecialpublication80060v1.pdf", "nistspecialpublication800-60v1.pdf"]
    assert value(spark, T.alternate_urls, "https://nvlpubs.nist.gov/nistpubs/Legacy/SP/nistspecialpublication800-60.pdf") == ["https://nvlpubs.nist.gov/nistpubs/SpecialPublications/NIST.SP.800-60.pdf"]
    assert value(spark, T.alternate_urls, "https://a.example/x.pdf") == []


def test_supersession(spark):
    said = value(spark, T.supersession_signals, "Rev. 5 is out; this one was withdrawn. Revision 3", "Rev 4")
    assert said == "page mentions 'withdrawn'; page mentions higher revision(s) [5] than manifest Rev 4"
    assert value(spark, T.supersession_signals, "nothing", "Rev 4") == ""
    assert value(spark, T.supersession_signals, "Rev 9", "") == ""


@pytest.mark.parametrize("raw,shown,key", [("ac-2", "AC-2", ("ac", 2, 0)), ("ac-2.3", "AC-2(3)", ("ac", 2, 3)), ("odd", "ODD", ("odd", 0, 0))])
def test_display_and_order(spark, raw, shown, key):
    assert value(spark, T.display_id, raw) == shown
    assert tuple(value(spark, T.control_sort_key, raw)) == key


def test_paragraphs_and_words(spark):
    assert value(spark, T.paragraphs, "a\n\n \n\nb \n\n") == ["a", "b"]
    assert value(spark, T.words, "Don't re-use 3 Keys") == ["don't", "re-use", "keys"]
    assert value(spark, T.fingerprint, " A\n b ") == "a b"


def test_task_order(spark):
    df = spark.createDataFrame([("P-11",), ("P-2",), ("C-3",)], "k string")
    assert [r.k for r in df.orderBy(T.task_sort_key(F.col("k"))).collect()] == ["C-3", "P-2", "P-11"]
