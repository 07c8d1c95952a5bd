"""Queries of the text functions and filters, over chunks, manifest_docs and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import schemas
from quern.functions import text as T


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Texts of the tables hold few of the characters and prefixes that the functions treat, so the queries add some to
#: every row: here, and alike in the SQL.
ODD = " ﬁeld “x” ‘y’ — … ​  a\tb\x07\n\n\n \n end ﬄ "
_ODD_SQL = "' ﬁeld “x” ‘y’ — … ' || chr(8203) || chr(160) || ' a' || chr(9) || 'b' || chr(7) || chr(10) || chr(10) || chr(10) || ' ' || chr(10) || ' end ﬄ '"


def normalized_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "chunks").select("row_no", T.normalize_text(F.concat("text", F.lit(ODD))).alias("text"))


def normal_sql(text: str) -> str:
    plain = f"translate({text}, '‘’“”–—−' || chr(160) || chr(8199) || chr(8239), '''''\"\"---   ')"
    for one, several in (*T.SEVERAL_FOR_ONE.items(), ("​", "")):
        plain = f"replace({plain}, {'chr(8203)' if one == '​' else repr(one)}, '{several}')"
    plain = rf"regexp_replace({plain}, '[\x00-\x08\x0b-\x1f\x7f-\x9f\p{{Cf}}\p{{Co}}]', '', 'g')"
    plain = f"regexp_replace(replace({plain}, chr(9), ' '), ' {{2,}}', ' ', 'g')"
    plain = rf"regexp_replace(regexp_replace({plain}, ' *\n *', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')"
    return rf"regexp_replace({plain}, '^\s+|\s+$', '', 'g')"


def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    accents = F.concat("title", F.lit(" Évaluation – Übersicht Ñandú 3.2"))
    return _table(spark, sf_dir, "manifest_docs").select("doc_id", T.slugify(accents).alias("slug"), T.make_id(F.col("doc_id"), F.lit("section"), accents).alias("id"))


_SLUG = "trim(regexp_replace(regexp_replace(lower(strip_accents(title || ' Évaluation – Übersicht Ñandú 3.2')), '[^\\x00-\\x7f]', '', 'g'), '[^a-z0-9.]+', '-', 'g'), '-')"


def length_floors(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _table(spark, sf_dir, "chunks").withColumn("floor", T.min_text_len(F.col("chunk_type")))
    outside = F.when(~F.length("text").between(F.col("floor"), schemas.MAX_TEXT), 1).otherwise(0)
    return chunks.groupBy("chunk_type").agg(F.count("*").alias("n"), F.min("floor").alias("floor"), F.sum(outside).alias("outside"))


def control_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _table(spark, sf_dir, "chunks").where("control_id IS NOT NULL").select("control_id").distinct()
    key = T.control_sort_key(F.col("control_id"))
    return ids.select("control_id", T.is_control_id(F.col("control_id")).alias("known"), T.display_id(F.col("control_id")).alias("shown"), key["family"].alias("family"), key["number"].alias("number"), key["enhancement"].alias("enhancement"))


def _prefixed() -> Column:
    """A prefix by row, so that every branch of the leading-furniture functions is met."""
    kinds = ["", "APPENDIX B PAGE B-2 ", "Chapter THREE\n", "[SP 800-53] ", "[NISTIR 7298] See (2019) available at ", "Ross, R. (2018) "]
    choice = F.col("row_no") % len(kinds)
    column = F.lit("")
    for k, kind in enumerate(kinds[1:], 1):
        column = F.when(choice == k, kind).otherwise(column)
    return F.concat(column, "text")


_PREFIXED = "CASE row_no % 6 WHEN 1 THEN 'APPENDIX B PAGE B-2 ' WHEN 2 THEN 'Chapter THREE' || chr(10) WHEN 3 THEN '[SP 800-53] ' WHEN 4 THEN '[NISTIR 7298] See (2019) available at ' WHEN 5 THEN 'Ross, R. (2018) ' ELSE '' END || text"
_HEADER_SQL = r"(?i)^(?:APPENDIX|CHAPTER)\s+[A-Za-z0-9-]{1,10}\s+(?:PAGE\s+[A-Za-z0-9-]{1,10}\s+)?"
_TAG_SQL = r"^\[[A-Z0-9][A-Za-z0-9 .\-]{0,40}\]\s*"
_REFERENCE_SQL = rf"CASE WHEN regexp_matches(t, '{_TAG_SQL}') THEN regexp_matches(substr(regexp_replace(t, '{_TAG_SQL}', ''), 1, 300), '(?i)(available at|https?://|\(\d{{4}}\)|\bU\.S\. Code\b|\bed\.\b|\bpp\.\s*\d|\bvol\.\s*\d)') ELSE regexp_matches(t, '^[A-Z][A-Za-z''’\-]+,\s+[A-Z]\.(\s*[A-Z]\.)*[,\s]+(\(\d{{4}}\)|[\"“])') END"


def leading_furniture(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "chunks").select("row_no", _prefixed().alias("t"))
    return rows.select("row_no", T.strip_running_header(F.col("t")).alias("without_header"), T.strip_reference_tag(F.col("t")).alias("without_tag"), T.is_reference_entry(F.col("t")).alias("reference"))


def plain_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """html_to_text, on chunks dressed as pages."""
    html = F.concat(F.lit('<html><head><style>p {a: b}</style>\n<SCRIPT type="x">if (a<b) {}</SCRIPT></head><p class="q">'), "text", F.lit("</p>\n\n&amp;lt;&nbsp;&quot;x&#39;<br/>&gt;"))
    return _table(spark, sf_dir, "chunks").select("row_no", T.html_to_text(html).alias("text"))


_PAGES = r"""SELECT row_no, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(
'<html><head><style>p {a: b}</style>' || chr(10) || '<SCRIPT type="x">if (a<b) {}</SCRIPT></head><p class="q">' || text || '</p>' || chr(10) || chr(10) || '&amp;lt;&nbsp;&quot;x&#39;<br/>&gt;',
'(?is)<script\b.*?</script>|<style\b.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&#39;', ''''), '&quot;', '"'), '\s+', ' ', 'g')) AS text FROM chunks"""


def ranked_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pdf_links: candidates on a landing page, ranked, the best three of each document."""
    number = T.document_number(F.col("doc_id"))
    html = F.concat(F.lit('<a HREF="/pubs/'), "doc_id", F.lit('.pdf">a</a><a href=\'https://nvlpubs.nist.gov/x/'), number, F.lit('.pdf\'>b</a><a href="other.pdf">c</a><a href="http://x.example/'), number, F.lit('.pdf">d</a><a href="https://nvlpubs.nist.gov/y.PDF">e</a>'))
    links = _table(spark, sf_dir, "manifest_docs").select("doc_id", F.slice(T.pdf_links(html, F.lit("https://docs.example/library/page.html"), F.col("doc_id")), 1, 3).alias("l"))
    return links.select("doc_id", F.posexplode("l").alias("p", "x")).select("doc_id", (F.col("p") + 1).alias("rank"), "x.score", "x.url")


_LINKS = r"""WITH d AS (SELECT doc_id, regexp_replace(lower(regexp_replace(doc_id, '^[^-]*-', '')), '[^a-z0-9]', '', 'g') AS n FROM manifest_docs),
u AS (SELECT doc_id, n, unnest(['https://docs.example/pubs/' || doc_id || '.pdf', 'https://nvlpubs.nist.gov/x/' || n || '.pdf', 'https://docs.example/library/other.pdf', 'https://nvlpubs.nist.gov/y.PDF']) AS url FROM d),
s AS (SELECT doc_id, url, CASE WHEN contains(regexp_replace(lower(url), '[^a-z0-9]', '', 'g'), n) THEN 2 ELSE 0 END + CASE WHEN contains(url, 'nvlpubs.nist.gov') THEN 1 ELSE 0 END AS score FROM u)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, url)::INT AS rank, score, url FROM s WHERE score > 0 QUALIFY rank <= 3"""


def other_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """alternate_urls, document_number and the artifact's place, for every document."""
    modern = F.concat(F.lit("https://nvlpubs.nist.gov/nistpubs/SpecialPublications/NIST.SP.800-"), T.document_number(F.col("doc_id")), F.lit(".pdf"))
    docs = _table(spark, sf_dir, "manifest_docs")
    return docs.select("doc_id", F.explode(T.alternate_urls(modern)).alias("url"))


def supersession(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What pages say of a publication's standing, and which documents are to be checked at all."""
    page = F.concat(F.lit("This publication was withdrawn. See Rev. 3 and Revision 12 of "), "title", F.lit("."))
    docs = _table(spark, sf_dir, "manifest_docs")
    return docs.select("doc_id", T.supersession_signals(page, F.col("revision")).alias("signals"), T.needs_supersession_check(F.col("doc_id"), F.col("notes"), ("QD-113",)).alias("check"), T.effective_source_url(F.col("url"), F.col("landing_page")).alias("source_url"))


_SUPERSESSION = r"""WITH r AS (SELECT *, try_cast(nullif(regexp_extract(revision, '(?i)\bRev(?:ision)?\.?\s*(\d+)\b', 1), '') AS INT) AS own,
list_sort(list_distinct(list_transform(regexp_extract_all('x Rev. 3 and Revision 12 of ' || title, '(?i)\bRev(?:ision)?\.?\s*(\d+)\b', 1), lambda x: x::INT))) AS seen FROM manifest_docs)
SELECT doc_id, 'page mentions ''withdrawn''' || CASE WHEN len(list_filter(seen, lambda x: x > own)) > 0 THEN '; page mentions higher revision(s) [' || array_to_string(list_filter(seen, lambda x: x > own), ', ') || '] than manifest Rev ' || own ELSE '' END AS signals,
(doc_id = 'QD-113') OR coalesce(regexp_matches(notes, '(?i)check (?:the )?landing page|if rev\w* \d+ is final|in development|was in draft'), false) AS check,
coalesce(nullif(url, ''), nullif(landing_page, ''), '') AS source_url FROM r"""


def paragraph_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = _table(spark, sf_dir, "chunks").select("row_no", F.posexplode(T.paragraphs(F.col("text"))).alias("place", "paragraph"))
    return exploded.select("row_no", "place", F.length("paragraph").alias("chars"), F.size(F.split("paragraph", r"(?<=[.;:])\s+")).alias("sentences"))


_PARAGRAPHS = r"""WITH p AS (SELECT row_no, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS l FROM chunks)
SELECT row_no, (i - 1)::INT AS place, length(l[i])::INT AS chars, len(string_split(regexp_replace(l[i], '([.;:])\s+', '\1' || chr(1), 'g'), chr(1)))::INT AS sentences FROM (SELECT row_no, l, unnest(range(1, len(l) + 1)) AS i FROM p)"""


def repeated_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose fingerprint an earlier one has."""
    rows = _table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", T.fingerprint(F.col("text")).alias("print"))
    first = rows.groupBy("print").agg(F.min("doc_id").alias("first"))
    return rows.join(first, "print").where("doc_id > first").select("doc_id", "first")


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents and in how many it occurs."""
    rows = _table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.explode(F.array_distinct(T.words(F.col("text")))).alias("word"))
    return rows.groupBy("word").agg(F.count("*").alias("documents"))


def predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many chunks each text filter selects."""
    text, path = F.col("t"), F.coalesce(F.col("section_path"), F.lit(""))
    tests = {
        "template": F.exists(F.array(*[F.lit(m) for m in T.TEMPLATE_MARKS]), lambda m: F.contains(text, m)), "furniture": text.rlike(T.FURNITURE[0]) | text.rlike(T.FURNITURE[1]) | text.rlike(T.FURNITURE[2]),
        "single": path.rlike(T.SINGLE_CHARACTER_SEGMENT), "mid_sentence": text.rlike(T.MID_SENTENCE[0]) | text.rlike(T.MID_SENTENCE[1]), "control": T.has_control_characters(text),
    }
    rows = _table(spark, sf_dir, "chunks").withColumn("t", F.when(F.col("row_no") % 7 == 0, F.concat(F.lit("NIST SP 800-53 Rev. 5   Page 7\n"), "text")).when(F.col("row_no") % 7 == 1, F.concat(F.lit("3.1 and "), "text")).otherwise(F.col("text")))
    return rows.groupBy("chunk_type").agg(*[F.count_if(test).alias(name) for name, test in tests.items()])


_PREDICATES = r"""WITH r AS (SELECT chunk_type, coalesce(section_path, '') AS p, CASE row_no % 7 WHEN 0 THEN 'NIST SP 800-53 Rev. 5   Page 7' || chr(10) || text WHEN 1 THEN '3.1 and ' || text ELSE text END AS t FROM chunks)
SELECT chunk_type, count_if(contains(t, '{{') OR contains(t, '}}') OR contains(t, 'insert: param') OR contains(t, 'You are a') OR contains(t, 'As an AI'))::BIGINT AS template,
count_if(regexp_matches(t, '(?i)^NIST SP 800-\d+[^\n]*Page \d+') OR regexp_matches(t, '^\s*\d+\s*$') OR regexp_matches(t, '(?i)this publication is available free of charge'))::BIGINT AS furniture,
count_if(regexp_matches(p, '(?:^|\s>\s)[A-Za-z0-9](?:\s>\s|$)'))::BIGINT AS single, count_if(regexp_matches(t, '^[a-z]') OR regexp_matches(t, '^\d[\d,.\-]*\s+[a-z]'))::BIGINT AS mid_sentence,
count_if(regexp_matches(t, '[\x00-\x08\x0b-\x1f\x7f-\x9f\p{Cf}\p{Co}]'))::BIGINT AS control FROM r GROUP BY chunk_type"""


def encoded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chunk as the JSON line it is stored as, by its hash."""
    line = F.to_json(F.struct("id", "doc_id", "tier", "control_id"), {"ignoreNullFields": "false"})
    return _table(spark, sf_dir, "chunks").select("row_no", F.sha2(line, 256).alias("sha256"), F.octet_length("text").alias("bytes"))


QUERIES = {f.__name__: f for f in (normalized_texts, slugs, length_floors, control_ids, leading_furniture, plain_pages, ranked_links, other_addresses, supersession, paragraph_lengths, repeated_texts, vocabulary, predicates, encoded_rows)}
ORACLES = {
    "normalized_texts": f"SELECT row_no, {normal_sql(f'(text || {_ODD_SQL})')} AS text FROM chunks",
    "slugs": f"SELECT doc_id, {_SLUG} AS slug, doc_id || '/section/' || {_SLUG} AS id FROM manifest_docs",
    "length_floors": f"SELECT chunk_type, count(*) AS n, min(f)::INT AS floor, sum(CASE WHEN length(text) BETWEEN f AND 8000 THEN 0 ELSE 1 END)::BIGINT AS outside FROM (SELECT *, CASE WHEN chunk_type IN {schemas.STRUCTURED_TYPES} THEN 80 ELSE 200 END AS f FROM chunks) GROUP BY chunk_type",
    "control_ids": rf"""SELECT control_id, regexp_matches(control_id, '^({"|".join(schemas.CONTROL_FAMILIES)})-\d+(\.\d+)?$') AS known,
upper(split_part(control_id, '.', 1)) || CASE WHEN contains(control_id, '.') AND NOT ends_with(control_id, '.') THEN '(' || regexp_replace(control_id, '^[^.]*\.', '') || ')' ELSE '' END AS shown,
CASE WHEN ok THEN split_part(control_id, '-', 1) ELSE control_id END AS family, CASE WHEN ok THEN regexp_extract(control_id, '-(\d+)', 1)::INT ELSE 0 END AS number,
CASE WHEN ok THEN coalesce(try_cast(nullif(regexp_extract(control_id, '\.(\d+)$', 1), '') AS INT), 0) ELSE 0 END AS enhancement
FROM (SELECT DISTINCT control_id, regexp_matches(control_id, '^[a-z]+-\d+(\.\d+)?$') AS ok FROM chunks WHERE control_id IS NOT NULL)""",
    "leading_furniture": rf"SELECT row_no, regexp_replace(regexp_replace(t, '{_HEADER_SQL}', ''), '^\s+', '') AS without_header, regexp_replace(regexp_replace(t, '{_TAG_SQL}', ''), '^\s+', '') AS without_tag, {_REFERENCE_SQL} AS reference FROM (SELECT row_no, {_PREFIXED} AS t FROM chunks)",
    "plain_pages": _PAGES,
    "ranked_links": _LINKS,
    "other_addresses": r"""WITH d AS (SELECT doc_id, '800-' || regexp_replace(lower(regexp_replace(doc_id, '^[^-]*-', '')), '[^a-z0-9]', '', 'g') AS n FROM manifest_docs)
SELECT doc_id, 'https://nvlpubs.nist.gov/nistpubs/Legacy/SP/nistspecialpublication' || unnest([replace(n, '-', ''), n]) || '.pdf' AS url FROM d""",
    "supersession": _SUPERSESSION,
    "paragraph_lengths": _PARAGRAPHS,
    "repeated_texts": r"WITH p AS (SELECT doc_id, lower(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')) AS print FROM documents WHERE text IS NOT NULL), f AS (SELECT print, min(doc_id) AS first FROM p GROUP BY print) SELECT doc_id, first FROM p JOIN f USING (print) WHERE doc_id > first",
    "vocabulary": "WITH w AS (SELECT unnest(list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z''’-]*'), lambda x: lower(x)))) AS word FROM documents WHERE text IS NOT NULL) SELECT word, count(*) AS documents FROM w GROUP BY word",
    "predicates": _PREDICATES,
    "encoded_rows": """SELECT row_no, sha256('{"id":' || to_json(id)::VARCHAR || ',"doc_id":' || to_json(doc_id)::VARCHAR || ',"tier":' || coalesce(tier::VARCHAR, 'null') || ',"control_id":' || coalesce(to_json(control_id)::VARCHAR, 'null') || '}') AS sha256, strlen(text)::INT AS bytes FROM chunks""",
}
