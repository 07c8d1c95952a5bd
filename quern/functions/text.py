"""Column expressions over text. All stay in the JVM.

`\\s` is ASCII in Java, so patterns that must treat every Unicode space alike carry `(?U)`; `$` would also match before
a final line end, so anchors are `\\z`.
"""

from __future__ import annotations

import json
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern import schemas

# Characters that are replaced, one for one, by several, or by none.
ONE_FOR_ONE = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "−": "-", " ": " ", " ": " ", " ": " "}
SEVERAL_FOR_ONE = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "…": "..."}
DROPPED = "​"

# Patterns on which results depend.
CONTROL_ID = r"^(?:" + "|".join(schemas.CONTROL_FAMILIES) + r")-\d+(?:\.\d+)?\z"
RUNNING_HEADER = r"(?i)^(?:APPENDIX|CHAPTER)\s+[A-Za-z0-9-]{1,10}\s+(?:PAGE\s+[A-Za-z0-9-]{1,10}\s+)?"
REFERENCE_TAG = r"^\[[A-Z0-9][A-Za-z0-9 .\-]{0,40}\]\s*"
CITATION = r"(?i)(?:available at|https?://|\(\d{4}\)|\bU\.S\. Code\b|\bed\.\b|\bpp\.\s*\d|\bvol\.\s*\d)"
AUTHOR_YEAR = "^[A-Z][A-Za-z'’\\-]+,\\s+[A-Z]\\.(?:\\s*[A-Z]\\.)*[,\\s]+(?:\\(\\d{4}\\)|[\"“])"
TEMPLATE_MARKS = ("{{", "}}", "insert: param", "You are a", "As an AI")
FURNITURE = (r"(?i)^NIST SP 800-\d+[^\n]*Page \d+", r"^\s*\d+\s*\z", r"(?i)this publication is available free of charge")
SINGLE_CHARACTER_SEGMENT = r"(?:^|\s>\s)[A-Za-z0-9](?:\s>\s|\z)"
MID_SENTENCE = (r"^[a-z]", r"^\d[\d,.\-]*\s+[a-z]")
REVISION = r"(?i)\bRev(?:ision)?\.?\s*(\d+)\b"
SUPERSESSION_NOTE = r"(?i)check (?:the )?landing page|if rev\w* \d+ is final|in development|was in draft"
CONTROL_CHARACTERS = r"[\p{C}&&[^\n\t]]"


#: Every character that is white space, by rule.
WHITE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(text, F.lit(WHITE))


def lstrip(text: Column) -> Column:
    return F.ltrim(text, F.lit(WHITE))


def normalize_text(text: Column) -> Column:
    """Typographic characters made plain, control characters dropped, white space collapsed; blank lines stay paragraph breaks."""
    plain = F.translate(text, "".join(ONE_FOR_ONE) + DROPPED, "".join(ONE_FOR_ONE.values()))
    for one, several in SEVERAL_FOR_ONE.items():
        plain = F.replace(plain, F.lit(one), F.lit(several))
    plain = F.translate(F.regexp_replace(plain, CONTROL_CHARACTERS, ""), "\t", " ")
    plain = F.regexp_replace(plain, " {2,}", " ")
    plain = F.regexp_replace(plain, " *\n *", "\n")
    return strip(F.regexp_replace(plain, "\n{3,}", "\n\n"))


def _ascii_forms() -> tuple[dict[str, str], dict[str, str]]:
    """By rule: what remains in ASCII of each compatibility-decomposed character, for one sign and for several."""
    one, several = {}, {}
    for code in range(0xA0, 0x20000):
        kept = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode() if not 0xD800 <= code < 0xE000 else ""
        if kept:
            (one if len(kept) == 1 else several)[chr(code)] = kept
    return one, several


_ASCII_ONE, _ASCII_SEVERAL = _ascii_forms()
_SEVERAL_CLASS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in _ASCII_SEVERAL) + "]"


def slugify(text: Column) -> Column:
    """A readable fragment of an id: ASCII letters, digits and dots in lower case, everything else one hyphen.

    Accents, full-width and mathematical letters, ligatures and fractions are resolved by compatibility decomposition;
    characters without an ASCII form vanish.
    """
    # Few texts hold a sign that stands for several; only those are gone through sign by sign.
    forms = F.from_json(F.lit(json.dumps(_ASCII_SEVERAL)), "map<string,string>")
    spelt = F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(forms, c), c)), "")
    plain = F.when(text.rlike(_SEVERAL_CLASS), spelt).otherwise(text)
    plain = F.translate(plain, "".join(_ASCII_ONE), "".join(_ASCII_ONE.values()))
    plain = F.lower(F.regexp_replace(plain, r"[^\x00-\x7F]", ""))
    return F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9.]+", "-"), "^-+|-+\\z", "")


def make_id(doc_id: Column, chunk_type: Column, source: Column) -> Column:
    """`{doc_id}/{chunk_type}/{slug}`; raises for an unknown type or an empty slug."""
    slug = slugify(source)
    built = F.concat_ws("/", doc_id, chunk_type, slug)
    unknown = F.raise_error(F.concat(F.lit("unknown chunk_type: "), chunk_type))
    empty = F.raise_error(F.concat(F.lit("no slug can be made of: "), source))
    return F.when(~chunk_type.isin(*schemas.CHUNK_TYPES), unknown.cast("string")).when(slug == "", empty.cast("string")).otherwise(built)


def min_text_len(chunk_type: Column) -> Column:
    return F.when(chunk_type.isin(*schemas.STRUCTURED_TYPES), schemas.MIN_TEXT_STRUCTURED).otherwise(schemas.MIN_TEXT)


def is_control_id(value: Column) -> Column:
    return value.rlike(CONTROL_ID)


def strip_running_header(text: Column) -> Column:
    """Without a leading running-header remnant, which may span lines; left-stripped."""
    return lstrip(F.regexp_replace(text, RUNNING_HEADER, ""))


def strip_reference_tag(text: Column) -> Column:
    return lstrip(F.regexp_replace(text, REFERENCE_TAG, ""))


def is_reference_entry(text: Column) -> Column:
    """Whether the text is an entry of a reference list: a tag with citation marks soon after, or author and year."""
    return F.when(text.rlike(REFERENCE_TAG), F.substring(F.regexp_replace(text, REFERENCE_TAG, ""), 1, 300).rlike(CITATION)).otherwise(text.rlike(AUTHOR_YEAR))


def fingerprint(text: Column) -> Column:
    """What near-duplicates share: lower case, white space collapsed."""
    return F.lower(strip(F.regexp_replace(text, r"(?U)\s+", " ")))


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n\n"), strip), lambda p: p != "")


def has_control_characters(text: Column) -> Column:
    return text.rlike(CONTROL_CHARACTERS)


def html_to_text(html: Column) -> Column:
    """Scripts, styles and tags out, six entities decoded in a fixed order, white space collapsed."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " ")
    text = F.regexp_replace(text, "<[^>]+>", " ")
    for entity, character in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&quot;", '"')):
        text = F.replace(text, F.lit(entity), F.lit(character))
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def document_number(doc_id: Column) -> Column:
    """The publication number as bare letters and digits: what follows the first hyphen, or all if nothing does."""
    rest = F.regexp_replace(doc_id, "^[^-]*-?", "")
    return F.regexp_replace(F.lower(F.when(rest == "", doc_id).otherwise(rest)), "[^a-z0-9]", "")


def _resolved(base: Column, href: Column) -> Column:
    """An absolute URL: a link against the page it stands on, for absolute, host-, root- and page-relative links."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, r"[?#].*\z", "")
    folder = F.when(page.rlike("^[^:]+://[^/]*\\z"), F.concat(page, F.lit("/"))).otherwise(F.regexp_replace(page, "[^/]*\\z", ""))
    joined = F.when(href.startswith("/"), F.concat(root, href)).otherwise(F.concat(folder, href))
    # Of the path, each parent folder takes the last one away; a last one of either kind leaves a folder.
    start = F.length(root) + 2
    segments = F.split(F.substr(joined, start), "/")
    walked = F.aggregate(segments, F.array().cast("array<string>"), lambda done, x: F.when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(F.array_append(done, x)))
    plain = F.concat(root, F.lit("/"), F.array_join(walked, "/"))
    return F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href)).otherwise(F.when(segments.isNotNull() & (F.exists(segments, lambda x: x.isin(".", ".."))), plain).otherwise(joined))


def pdf_links(html: Column, base_url: Column, doc_id: Column, preferred_host: str = "nvlpubs.nist.gov") -> Column:
    """Array of (score, url), best first: https links to PDF files that name the publication (2) or its home (1).

    Double slashes, parent folders and fragments are resolved; links with no score are left out.
    """
    number = document_number(doc_id)
    hrefs = F.regexp_extract_all(html, F.lit("(?i)href=[\"']([^\"']+?\\.pdf)[\"']"), 1)
    urls = F.array_distinct(F.filter(F.transform(hrefs, lambda h: _resolved(base_url, h)), lambda u: u.startswith("https://")))

    def scored(url: Column) -> Column:
        flat = F.regexp_replace(F.lower(url), "[^a-z0-9]", "")
        names = F.when((number != "") & flat.contains(number), 2).otherwise(0)
        return F.struct((-(names + F.when(url.contains(preferred_host), 1).otherwise(0))).alias("rank"), url.alias("url"))

    ranked = F.array_sort(F.filter(F.transform(urls, scored), lambda x: x["rank"] < 0))
    return F.transform(ranked, lambda x: F.struct((-x["rank"]).alias("score"), x["url"].alias("url")))


def alternate_urls(url: Column) -> Column:
    """The other places a publication may be at: between the modern and the legacy folder, 0 to 2 candidates."""
    modern, legacy = r"/nistpubs/SpecialPublications/NIST\.SP\.(.+)\.pdf\z", r"/nistpubs/Legacy/SP/nistspecialpublication(.+)\.pdf\z"
    number, old = F.regexp_extract(url, modern, 1), F.regexp_extract(url, legacy, 1)
    place = "https://nvlpubs.nist.gov/nistpubs/"
    to_legacy = F.array(F.concat(F.lit(place + "Legacy/SP/nistspecialpublication"), F.replace(number, F.lit("-"), F.lit("")), F.lit(".pdf")), F.concat(F.lit(place + "Legacy/SP/nistspecialpublication"), number, F.lit(".pdf")))
    to_modern = F.array(F.concat(F.lit(place + "SpecialPublications/NIST.SP."), F.regexp_replace(old, "^800(?!-)", "800-"), F.lit(".pdf")))
    return F.when(number != "", to_legacy).when(old != "", to_modern).otherwise(F.array().cast("array<string>"))


def supersession_signals(page_text: Column, revision: Column) -> Column:
    """What a landing page says of the publication's standing, joined by '; '; empty if nothing.

    The text is that of the page without markup. Higher revisions are those above the one given.
    """
    low = F.lower(page_text)
    snippet = F.regexp_extract(low, r"(?s)(.{80}superseded.{120})", 1)
    around = F.when(snippet != "", strip(snippet)).otherwise("superseded")
    own = F.try_to_number(F.regexp_extract(revision, REVISION, 1), F.lit("999999999")).cast("int")
    mentioned = F.transform(F.regexp_extract_all(page_text, F.lit(REVISION), 1), lambda r: r.try_cast("int"))
    higher = F.array_sort(F.array_distinct(F.filter(mentioned, lambda r: r > own)))
    higher_note = F.concat(F.lit("page mentions higher revision(s) ["), F.array_join(higher.cast("array<string>"), ", "), F.lit("] than manifest Rev "), own.cast("string"))
    notes = F.array(
        F.when(low.contains("withdrawn"), F.lit("page mentions 'withdrawn'")),
        F.when(low.contains("superseded"), F.concat(F.lit("page mentions 'superseded': …"), around, F.lit("…"))),
        F.when(F.size(higher) > 0, higher_note),
    )
    return F.array_join(F.array_compact(notes), "; ")


def needs_supersession_check(doc_id: Column, notes: Column, watchlist: tuple[str, ...] = ()) -> Column:
    listed = doc_id.isin(*watchlist) if watchlist else F.lit(False)
    return F.coalesce(listed, F.lit(False)) | F.coalesce(notes.rlike(SUPERSESSION_NOTE), F.lit(False))


def effective_source_url(url: Column, landing_page: Column) -> Column:
    """The artifact's URL, else the landing page, else nothing; empty counts as none."""
    return F.coalesce(F.nullif(url, F.lit("")), F.nullif(landing_page, F.lit("")), F.lit(""))


def display_id(control_id: Column) -> Column:
    """ac-2.3 as AC-2(3)."""
    number = F.regexp_replace(control_id, r"^[^.]*\.?", "")
    return F.concat(F.upper(F.split_part(control_id, F.lit("."), F.lit(1))), F.when(number != "", F.concat(F.lit("("), number, F.lit(")"))).otherwise(""))


def control_sort_key(control_id: Column) -> Column:
    """Struct (family, number, enhancement) by which ids sort as readers expect; (id, 0, 0) for other forms."""
    form = r"^([a-z]+)-(\d+)(?:\.(\d+))?\z"

    def part(group: int) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(control_id, form, group), F.lit("")).try_cast("int"), F.lit(0))

    matches = control_id.rlike(form)
    return F.struct(F.when(matches, F.regexp_extract(control_id, form, 1)).otherwise(control_id).alias("family"), F.when(matches, part(2)).otherwise(0).alias("number"), F.when(matches, part(3)).otherwise(0).alias("enhancement"))


def words(text: Column) -> Column:
    """Words of letters, apostrophes and hyphens, in lower case."""
    return F.transform(F.regexp_extract_all(text, F.lit("([A-Za-z][A-Za-z'’-]*)"), 1), F.lower)


def task_sort_key(key: Column) -> Column:
    """Struct (letter, number) by which task keys such as P-2 and P-11 sort."""
    return F.struct(F.substring(key, 1, 1).alias("letter"), F.coalesce(F.regexp_extract(key, r"-(\d+)\z", 1).try_cast("int"), F.lit(0)).alias("number"))
