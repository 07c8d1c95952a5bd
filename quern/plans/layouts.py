"""Queries of laid-out documents: the texts of one source make up a document, each text a page, each line a line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import layout, ordered, publications
from quern.session import stored
from quern.sources import pdf


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of all documents, with type that the tables do not have: short lines without a full stop are set large."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text IS NOT NULL")
    cut = docs.select(F.coalesce("source", F.lit("none")).alias("doc_id"), F.col("doc_id").alias("_page"), F.posexplode(F.split("text", "\n")).alias("_n", "text"))
    large = (F.length("text") < 60) & ~F.col("text").endswith(".")
    return cut.select("doc_id", (F.col("_page") * 100_000 + F.col("_n")).alias("line_no"), "text", F.col("_page").alias("page"), F.when(large, 13.0).otherwise(10.0).alias("size"), F.col("text").endswith(":").alias("bold"), F.col("_n").cast("double").alias("y"))


def body_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.body_font_size(lines(spark, sf_dir))


def printed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents as if printed: pages numbered from 1, each with a running header, the first with a table of
    contents of an entry for each page, nine at most."""
    plain = lines(spark, sf_dir)
    pages = plain.groupBy("doc_id", F.col("page").alias("_page")).agg(F.min("line_no").alias("line_no"))
    pages = stored(ordered.running_sum(pages, "page", F.lit(1), ["doc_id"], "line_no").withColumn("page", F.col("page").cast("int")), "pages")
    header = pages.select("doc_id", (F.col("line_no") - 50_000).alias("line_no"), F.concat(F.lit("  Handbook of "), "doc_id", F.lit("   page "), F.col("page").cast("string")).alias("text"), "page")
    first = pages.groupBy("doc_id").agg(F.min("page").alias("page"), F.min("line_no").alias("line_no"), F.count("*").alias("n"))
    entry = first.select("doc_id", "page", "line_no", F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(9)).cast("int"))).alias("k"))
    listed = entry.select("doc_id", (F.col("line_no") - 40_000 + F.col("k")).alias("line_no"), F.concat(F.lit("Part "), F.col("k").cast("string"), F.lit(" of the handbook   "), (F.col("k") + 2).cast("string")).alias("text"), "page")
    more = header.unionByName(listed).select("doc_id", "line_no", "text", "page", F.lit(10.0).alias("size"), F.lit(False).alias("bold"), F.lit(0.0).alias("y"))
    numbered = plain.withColumnRenamed("page", "_page").join(pages.select("doc_id", "_page", "page"), ["doc_id", "_page"])
    return numbered.select(*plain.columns).unionByName(more)


def span_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the documents from spans, one for each word and each space: long words are bold, words set by length."""
    plain = lines(spark, sf_dir)
    word = lambda w: F.struct(w.alias("text"), (F.length(w) % 7 + 8.25).cast("double").alias("size"), F.when(F.length(w) > 6, 16).otherwise(4).alias("flags"))
    space = F.struct(F.lit(" ").alias("text"), F.lit(30.0).alias("size"), F.lit(16).alias("flags"))
    cut = F.flatten(F.transform(F.split("text", " "), lambda w: F.array(word(w), space)))
    return pdf.lines_of(plain.select("doc_id", "page", "line_no", (F.col("y") + 0.25).alias("y"), cut.alias("spans")))


def repeating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.repeating_furniture(printed(spark, sf_dir))


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.contents_pages(printed(spark, sf_dir))


def content_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the printed documents without their furniture."""
    return layout.without_furniture(printed(spark, sf_dir)).select("doc_id", "line_no", "page")


def heading_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.with_levels(lines(spark, sf_dir)).where("level IS NOT NULL").select("doc_id", "line_no", "level")


def section_trails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as headings of changing depth: the ancestors of each, by place."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("kind"), "event_id", "user_id")
    level = (F.length("kind") % 3 + 1).cast("int")
    rows = events.select(F.concat(F.lit("u"), (F.col("user_id") % 50).cast("string")).alias("doc_id"), F.col("event_id").alias("line_no"), F.repeat(F.lit("1."), level - 1).alias("_p"), "kind", F.col("event_id").cast("int").alias("page"))
    laid = rows.select("doc_id", "line_no", F.concat("_p", F.lit("1 head "), F.col("line_no").cast("string")).alias("text"), "page", F.lit(10.0).alias("size"), F.lit(False).alias("bold"), F.lit(0.0).alias("y"))
    return layout.sectioned(laid).where("level IS NOT NULL").select("doc_id", "line_no", "level", "section", F.size("trail").alias("depth"), F.get("trail", F.size("trail") - 1).alias("parent"))


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = layout.sections(lines(spark, sf_dir))
    return found.select("doc_id", "section", "level", "page", "heading", F.array_join("trail", " > ").alias("trail"), F.size("lines").alias("lines"), F.md5(F.array_join("lines", "\n")).alias("md5"))


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definition chunks as glossary lines."""
    chunks = spark.read.parquet(f"{sf_dir}/chunks.parquet").where("doc_id IS NOT NULL")
    cut = chunks.select("doc_id", F.col("row_no"), F.posexplode(F.split("text", "\n")).alias("_n", "text")).withColumn("line_no", F.col("row_no") * 100_000 + F.col("_n"))
    return layout.extract_definitions(cut.select("doc_id", "line_no", "text")).select("doc_id", "first_line", "term", F.length("text").alias("chars"))


def longest_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the blocks that start at a list marker, the longest of each marker in a document."""
    marked = layout.sectioned(lines(spark, sf_dir))
    blocks = stored(layout.extract_blocks(marked, r"^([a-z0-9]{1,3})[.)]\s", max_span_level=1), "blocks")
    kept, stubs = layout.keep_longest(blocks)
    return kept.select("doc_id", "key", "block", F.lit(True).alias("kept")).unionByName(stubs.select("doc_id", "key", "block", F.lit(False).alias("kept")))


def dehyphenated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk's lines joined, hyphens at line ends settled by the words of its document."""
    chunks = spark.read.parquet(f"{sf_dir}/chunks.parquet").where("doc_id IS NOT NULL")
    words = layout.vocabulary(chunks.select("doc_id", "text"))
    blocks = chunks.select("doc_id", F.col("row_no").alias("block"), F.split("text", "\n").alias("lines"))
    return layout.needed_words(blocks, words).select(F.col("block").alias("row_no"), layout.join_lines(F.col("lines"), F.col("known")).alias("text"))


def impact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders by status and level of priority as a grid, transcribed."""
    return _orders_grid(spark, sf_dir).select(layout.transcribe_impact_table(layout.trim_grid(F.col("g"))).alias("text"))


def _orders_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: the orders by status and level of priority, with blank columns and ragged rows."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rank = F.substring("o_orderpriority", 1, 1)
    level = F.when(rank.isin("1", "2"), "HIGH").when(rank == "3", "MODERATE").otherwise("LOW")
    counts = orders.groupBy("o_orderstatus").agg(*[F.count_if(level == n).alias(n) for n in ("LOW", "MODERATE", "HIGH")])
    label = F.when(F.col("o_orderstatus") == "F", "CONFIDENTIALITY: keeping").when(F.col("o_orderstatus") == "O", "Integrity").otherwise("Availability -  being there.")
    row = F.array(label, F.lit(" "), *[F.concat(F.lit(" n = "), F.col(n).cast("string")) for n in ("LOW", "MODERATE", "HIGH")])
    # One row for each of the three statuses.
    return counts.agg(F.array_sort(F.collect_list(row)).alias("g")).select(F.concat(F.array(F.array(F.lit(""), F.lit(None), F.lit("LOW"), F.lit("MODERATE"), F.lit("HIGH"))), "g").alias("g"))


def publication_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all documents with their ids, repeated ones numbered."""
    rows, _ = publications.parse_publications(lines(spark, sf_dir))
    return publications.identified(rows).select("doc_id", "id", "chunk_type", F.md5("text").alias("md5"), "section_path", "page")


def publication_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publications.parse_publications(lines(spark, sf_dir))[1].groupBy("doc_id", "rule").agg(F.count("*").alias("n"))


#: Documents are dressed as the known publications in this order, by their number; each page begins with an identifier
#: (with {j} from 1 to 5) where the publication has any. Page 1,000,000 holds glossaries, tables and appendices.
_DRESSED = ("FIPS-199", "FIPS-200", "SP-800-37r2", "SP-800-60v2r1", "SP-800-137", "AI-100-1", "SP-800-218", "SP-800-218A")
_LAST = 1_000_000


def dressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pages of the known publications, in one size of type, with glossaries of nations and an appendix."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text IS NOT NULL")
    pub = F.array(*[F.lit(d) for d in _DRESSED])[F.pmod(F.col("doc_id"), F.lit(len(_DRESSED))).cast("int")]
    j = (F.floor(F.col("doc_id") / len(_DRESSED)) % 5 + 1).cast("string")
    areas = F.array(F.lit("Access Control (AC)"), F.lit("Awareness and Training (AT)"), F.lit("Audit, Logs and Accountability (AU)"))
    first = (
        F.when(pub == "FIPS-200", F.concat(areas[(F.col("doc_id") % 3).cast("int")], F.lit(": who may enter")))
        .when(pub == "SP-800-37r2", F.concat(F.lit("TASK P-"), j, F.lit(" prepare the work")))
        .when(pub == "SP-800-60v2r1", F.concat(F.lit("D."), j, F.lit(" Information type")))
        .when(pub == "AI-100-1", F.concat(F.lit("GOVERN "), j, F.lit(".1: policies are in place")))
        .when(pub.startswith("SP-800-218"), F.concat(F.lit("PO."), j, F.lit(".1: define who well-"))).otherwise("plain beginning of a page")
    )
    cut = docs.select(pub.alias("doc_id"), F.col("doc_id").alias("_page"), F.posexplode(F.concat(F.array(first), F.split("text", "\n"))).alias("_n", "text"))
    pages = cut.select("doc_id", (F.col("_page") * 100_000 + F.col("_n")).alias("line_no"), "text", F.col("_page").alias("page"), F.lit(10.0).alias("size"), F.lit(False).alias("bold"))
    at = _LAST * 100_000
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet").select((F.lit(at + 1) + 2 * F.col("n_nationkey")).cast("bigint").alias("line_no"), F.lower("n_name").alias("term"), F.concat(F.lit("Place number "), F.col("n_nationkey").cast("string"), F.lit(" of region "), F.col("n_regionkey").cast("string"), F.lit(", as the table of nations has it.")).alias("about"))
    title = spark.createDataFrame([("SP-800-37r2", "GLOSSARY"), ("SP-800-137", "GLOSSARY"), ("FIPS-199", "TABLE 1: POTENTIAL IMPACT DEFINITIONS"), ("SP-800-60v2r1", "APPENDIX E memoranda")], "doc_id string, text string")
    # In larger tables pages follow the glossaries: a rule in display type, no content, ends them on their own page.
    rules = spark.createDataFrame([("SP-800-37r2",), ("SP-800-137",)], "doc_id string").select("doc_id", F.lit(at + 100_000).cast("bigint").alias("line_no"), F.lit("_" * 6).alias("text"), F.lit(_LAST + 1).alias("page"), F.lit(16.0).alias("size"), F.lit(False).alias("bold"))
    titles = title.select("doc_id", F.lit(at).cast("bigint").alias("line_no"), "text", F.lit(_LAST).alias("page"), F.lit(16.0).alias("size"), F.lit(False).alias("bold"))
    both = nations.select("*", F.explode(F.array(F.lit("SP-800-37r2"), F.lit("SP-800-137"))).alias("doc_id"))
    entries = both.select("doc_id", F.explode(F.array(F.struct("line_no", F.col("term").alias("text"), F.lit(True).alias("bold")), F.struct((F.col("line_no") + 1).alias("line_no"), F.col("about").alias("text"), F.lit(False).alias("bold")))).alias("x")).select("doc_id", "x.line_no", "x.text", F.lit(_LAST).alias("page"), F.lit(10.0).alias("size"), "x.bold")
    return pages.unionByName(titles).unionByName(rules).unionByName(entries).withColumn("y", F.lit(0.0))


def _treated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    grids = _orders_grid(spark, sf_dir).select(F.lit("FIPS-199").alias("doc_id"), F.lit(_LAST).alias("page"), F.col("g").alias("grid"))
    return publications.parse_publications(dressed(spark, sf_dir), grids)


def treated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the treatments of the known publications give beside sections: blocks, glossaries told by type, the table."""
    return _treated(spark, sf_dir)[0].where(F.col("part") != publications.SECTIONS).where(F.col("part") != publications.DEFINITIONS).select("doc_id", "chunk_type", "slug", F.md5("text").alias("md5"), "section_path", "page")


def treated_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that the treatments leave out: stubs, short blocks, sections that blocks cover, the appendix."""
    return _treated(spark, sf_dir)[1].groupBy("doc_id", "rule").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (body_sizes, span_lines, repeating_lines, contents, content_lines, heading_levels, section_trails, sections, definitions, longest_blocks, dehyphenated, impact_table, publication_rows, publication_rejections, treated_rows, treated_rejections)}

_LINES = """l AS (SELECT coalesce(source, 'none') AS doc_id, doc_id * 100000 + i - 1 AS line_no, t[i] AS text, doc_id::INT AS page, CASE WHEN length(t[i]) < 60 AND NOT ends_with(t[i], '.') THEN 13.0 ELSE 10.0 END::DOUBLE AS size, ends_with(t[i], ':') AS bold
FROM (SELECT source, doc_id, string_split(text, chr(10)) AS t FROM documents WHERE text IS NOT NULL), unnest(range(1, len(t) + 1)) AS u(i))"""
_S = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"
_KEY = f"regexp_replace(regexp_replace(lower({_S}), '\\s+', ' ', 'g'), '\\d+', '#', 'g')"
#: The printed documents: pl.
_PRINTED = (
    _LINES
    + """, pg AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no)::INT AS page FROM (SELECT doc_id, page AS old, min(line_no) AS line_no FROM l GROUP BY ALL)), fp AS (SELECT doc_id, min(page) AS page, min(line_no) AS line_no, count(*) AS n FROM pg GROUP BY doc_id),
pl AS (SELECT l.doc_id, l.line_no, text, pg.page, size, bold FROM l JOIN pg ON pg.doc_id = l.doc_id AND pg.old = l.page UNION ALL SELECT doc_id, line_no - 50000, '  Handbook of ' || doc_id || '   page ' || page, page, 10.0, false FROM pg
UNION ALL SELECT doc_id, line_no - 40000 + k, 'Part ' || k || ' of the handbook   ' || (k + 2), page, 10.0, false FROM fp, unnest(range(1, least(n, 9) + 1)) AS u(k))"""
)
_PLAIN = r"'^$|^[_\-=–—\s]{6,}$|^(?i:(?:page\s+)?[ivxlcdm\d]+(?:\s+of\s+\d+)?)$|\.{4,}\s*\d*\s*$|(?i:this publication is available free of charge|^https?://(?:dx\.)?doi\.org/|^\s*NIST (?:Special Publication|SP)\s+[\d\-.A-Za-z]+\s*$|national institute of standards and technology|u\.s\. department of commerce)'"
_ENTRY = r"'(?i)^[^\s][^\n]{2,90}?[\s.]+(\d{1,3}|[ivxl]{1,6})$'"


def _content(source: str) -> str:
    """CTEs over lines `source`: rep (furniture keys), con (contents pages), ct (the lines that are content)."""
    return f"""np AS (SELECT doc_id, max(page) AS n FROM {source} GROUP BY doc_id),
rep AS (SELECT doc_id, {_KEY} AS key FROM {source} JOIN np USING (doc_id) WHERE length({_S}) >= 3 GROUP BY doc_id, key, n HAVING count(DISTINCT page) > greatest(2, floor(n * 0.5))),
con AS (SELECT doc_id, page FROM {source} JOIN np USING (doc_id) WHERE page <= greatest(3, floor(n * 0.2)) AND regexp_matches({_S}, {_ENTRY}) GROUP BY doc_id, page HAVING count(*) >= 5),
ct AS (SELECT * FROM {source} s WHERE NOT regexp_matches({_S}, {_PLAIN}) AND NOT EXISTS (SELECT 1 FROM rep WHERE rep.doc_id = s.doc_id AND rep.key = {_KEY}) AND NOT EXISTS (SELECT 1 FROM con WHERE con.doc_id = s.doc_id AND con.page = s.page))"""


def _sized(name: str, source: str) -> str:
    """CTE `name`: the body size of each document of `source`."""
    return f"{name} AS (SELECT doc_id, size AS body_size FROM (SELECT doc_id, size, sum(length(text)) AS w, min(line_no) AS first FROM {source} GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, first) = 1)"


def _levelled(name: str, source: str, sizes: str) -> str:
    """CTE `name`: the lines of `source` stripped, as t, with their level."""
    return rf"""{name} AS (SELECT *, CASE WHEN t = '' OR length(t) > 160 OR length(t) = 1 THEN NULL WHEN regexp_matches(t, '[.;]$') AND NOT up AND NOT kw THEN NULL
WHEN regexp_matches(t, '^\d+(\.\d+)*\s+\S') AND length(t) <= 120 AND size + 0.2 >= body_size THEN length(regexp_replace(regexp_extract(t, '^(\d+(?:\.\d+)*)\s', 1), '[^.]', '', 'g')) + 1
WHEN kw THEN CASE WHEN regexp_matches(t, '(?i)^TASK') THEN 3 ELSE 1 END WHEN regexp_matches(t, '^[A-Z](\.\d+)+\s+\S') THEN length(regexp_replace(regexp_extract(t, '^([A-Z](?:\.\d+)+)\s', 1), '[^.]', '', 'g')) + 1
WHEN length(t) <= 80 AND NOT ends_with(t, '.') AND NOT (regexp_matches(t, '^[•▪◦○*·–—-]\s') OR regexp_matches(t, '[,;]$') OR trim(lower(regexp_extract(t, '([^ ]*)$', 1)), ',;:') IN ('and', 'or', 'the', 'of', 'to', 'a', 'an', 'for', 'with', 'in'))
THEN CASE WHEN size >= body_size + 1 THEN 2 WHEN (bold OR up) AND size >= body_size THEN 3 END END::INT AS level
FROM (SELECT *, {_S} AS t, regexp_matches({_S}, '(?i)^(CHAPTER|APPENDIX|ANNEX|SECTION|TASK)\s+[A-Z0-9][-A-Z0-9.]*\s*:?') AS kw, upper({_S}) = {_S} AND regexp_matches({_S}, '\p{{L}}') AS up FROM {source} JOIN {sizes} USING (doc_id)))"""


#: x: content lines of `l` with level and section; sec: sections with heading, trail (a list) and body lines.
_SECTIONS = f"""{_content("l")}, {_sized("b", "ct")}, {_levelled("lv", "ct", "b")},
x AS (SELECT *, count(level) OVER (PARTITION BY doc_id ORDER BY line_no) AS section FROM lv),
hd AS (SELECT doc_id, section, level, t FROM x WHERE level IS NOT NULL),
tr AS (SELECT h.doc_id, h.section, list(a.t ORDER BY a.section) AS trail FROM hd h JOIN hd a ON a.doc_id = h.doc_id AND a.section < h.section AND a.level < h.level
  WHERE NOT EXISTS (SELECT 1 FROM hd m WHERE m.doc_id = h.doc_id AND m.section > a.section AND m.section < h.section AND m.level <= a.level) GROUP BY ALL),
sec AS (SELECT doc_id, section, coalesce(max(level), 0) AS level, min(page) AS page, coalesce(max(CASE WHEN level IS NOT NULL THEN t END), '') AS heading, coalesce(list(t ORDER BY line_no) FILTER (level IS NULL), []) AS body, coalesce(any_value(trail), []) AS trail FROM x LEFT JOIN tr USING (doc_id, section) GROUP BY doc_id, section)"""
_SECTIONED = f"WITH RECURSIVE {_LINES}, {_SECTIONS}"
_CLEAN = r"regexp_replace(regexp_replace({0}, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')"
_DROPPED = r"'(?i)(gaithersburg|submit comments|trademark|patent disclosure|^abstract$|^keywords$|^acknowledg|^disclaimer|^audience$|bureau drive|attn:|^certain commercial)'"
_SLUG = r"trim(regexp_replace(regexp_replace(lower(strip_accents({0})), '[^\x00-\x7f]', '', 'g'), '[^a-z0-9.]+', '-', 'g'), '-')"
_DEFINES = r"'^[A-Z][A-Za-z0-9()/,''’\- ]{2,70}?\s*[:–—]\s+[A-Z(\[][^\n]*$'"
#: em: the rows of documents without a treatment, in the order of emission; rj: their rejections.
_EMITTED = (
    rf""",
{_sized("b2", "l")}, {_levelled("lv2", "l", "b2")},
st AS (SELECT doc_id, CASE WHEN f.page <= greatest(3.0, n * 0.33) THEN f.page ELSE 1 END AS start FROM np LEFT JOIN (SELECT doc_id, min_by(page, line_no) AS page FROM lv2 WHERE level = 1 AND (regexp_extract(t, '^(\d+(?:\.\d+)*)\s+\S', 1) = '1' OR regexp_matches(t, '(?i)^(CHAPTER|SECTION)\s'))
  AND NOT EXISTS (SELECT 1 FROM con WHERE con.doc_id = lv2.doc_id AND con.page = lv2.page) GROUP BY doc_id) f USING (doc_id)),
fr AS (SELECT sec.*, st.start, sec.page < st.start AND NOT regexp_matches(heading, '(?i)^(executive summary|abstract)\b') AS gone FROM sec JOIN st USING (doc_id)),
nm AS (SELECT doc_id, list(DISTINCT heading) AS names FROM fr WHERE gone GROUP BY doc_id),
kp AS (SELECT fr.doc_id, section, page, heading, body, list_filter(trail, lambda h: NOT list_contains(coalesce(nm.names, []), h)) AS trail, regexp_matches(heading, '(?i)(terms and definitions|glossary|appendix\s+[a-z]\s*[-—:]?\s*(glossary|terms))') AS glossary FROM fr LEFT JOIN nm USING (doc_id) WHERE NOT gone),
sp AS (SELECT *, {_CLEAN.format("heading")} AS h, regexp_replace(array_to_string(body, chr(10)), '^\s+|\s+$', '', 'g') AS bd, array_to_string(list_filter(list_transform(list_append(list_filter(trail, lambda h: NOT regexp_matches(h, {_DROPPED})), heading), lambda h: {_CLEAN.format("h")}), lambda h: h <> ''), ' > ') AS path FROM kp),
tx AS (SELECT *, CASE WHEN h <> '' AND bd <> '' THEN h || chr(10) || chr(10) || bd ELSE h || bd END AS text FROM sp WHERE NOT glossary),
de AS (SELECT *, sum(CASE WHEN ds THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, section ORDER BY line_no) AS entry FROM (SELECT x.doc_id, x.section, x.line_no, x.t, regexp_matches(x.t, {_DEFINES}) AS ds, sp.path FROM x JOIN sp USING (doc_id, section) WHERE glossary AND x.level IS NULL)),
dt AS (SELECT doc_id, section, entry, any_value(path) AS path, min(line_no) AS first_line, {_CLEAN.format("max(CASE WHEN ds THEN regexp_extract(t, '^([A-Z][A-Za-z0-9()/,''’" + chr(92) + "- ]{2,70}?)" + chr(92) + "s*[:–—]" + chr(92) + "s+[A-Z(" + chr(92) + "[]', 1) END)")} AS term,
  string_agg(CASE WHEN ds THEN regexp_extract(t, '^[A-Z][A-Za-z0-9()/,''’\- ]{{2,70}}?\s*[:–—]\s+([A-Z(\[][^\n]*)$', 1) ELSE t END, ' ' ORDER BY line_no) AS bd FROM de WHERE entry > 0 GROUP BY doc_id, section, entry),
em AS (SELECT doc_id, 'section' AS chunk_type, CASE WHEN {_SLUG.format("h")} <> '' THEN h ELSE 'page-' || page END AS slug, text, path AS section_path, page, (SELECT min(line_no) FROM x WHERE x.doc_id = tx.doc_id AND x.section = tx.section) AS first_line FROM tx WHERE length({_S}) >= 40
  UNION ALL SELECT doc_id, 'definition', term, term || ': ' || regexp_replace(bd, '^\s+|\s+$', '', 'g'), concat_ws(' > ', path, term), NULL, first_line FROM dt WHERE length(term || ': ' || regexp_replace(bd, '^\s+|\s+$', '', 'g')) >= 40),
rj AS (SELECT doc_id, 'front_matter' AS rule FROM fr WHERE gone GROUP BY doc_id UNION ALL SELECT doc_id, 'section_too_short' FROM tx WHERE length({_S}) < 40
  UNION ALL SELECT doc_id, 'definition_too_short' FROM dt WHERE length(term || ': ' || regexp_replace(bd, '^\s+|\s+$', '', 'g')) < 40)"""
)
_PUBLISHED = _SECTIONED + _EMITTED
#: The dressed documents as l, and the treatments: pattern of identifiers, what ends a block, and how its row is made.
_DRESSED_SQL = r"""WITH RECURSIVE pubs AS (SELECT ['FIPS-199', 'FIPS-200', 'SP-800-37r2', 'SP-800-60v2r1', 'SP-800-137', 'AI-100-1', 'SP-800-218', 'SP-800-218A'] AS p),
dd AS (SELECT p[doc_id % 8 + 1] AS doc_id, doc_id AS pg, (doc_id // 8) % 5 + 1 AS j, text FROM documents, pubs WHERE text IS NOT NULL),
ds AS (SELECT doc_id, pg, list_prepend(CASE doc_id WHEN 'FIPS-200' THEN ['Access Control (AC)', 'Awareness and Training (AT)', 'Audit, Logs and Accountability (AU)'][pg % 3 + 1] || ': who may enter' WHEN 'SP-800-37r2' THEN 'TASK P-' || j || ' prepare the work' WHEN 'SP-800-60v2r1' THEN 'D.' || j || ' Information type'
  WHEN 'AI-100-1' THEN 'GOVERN ' || j || '.1: policies are in place' WHEN 'SP-800-218' THEN 'PO.' || j || '.1: define who well-' WHEN 'SP-800-218A' THEN 'PO.' || j || '.1: define who well-' ELSE 'plain beginning of a page' END, string_split(text, chr(10))) AS t FROM dd),
gl AS (SELECT d AS doc_id, n_nationkey AS k, lower(n_name) AS term, 'Place number ' || n_nationkey || ' of region ' || n_regionkey || ', as the table of nations has it.' AS about FROM nation, (VALUES ('SP-800-37r2'), ('SP-800-137')) AS v(d)),
l AS (SELECT doc_id, pg * 100000 + i - 1 AS line_no, t[i] AS text, pg::INT AS page, 10.0::DOUBLE AS size, false AS bold FROM ds, unnest(range(1, len(t) + 1)) AS u(i)
  UNION ALL SELECT d, 100000000000, t, 1000000, 16.0, false FROM (VALUES ('SP-800-37r2', 'GLOSSARY'), ('SP-800-137', 'GLOSSARY'), ('FIPS-199', 'TABLE 1: POTENTIAL IMPACT DEFINITIONS'), ('SP-800-60v2r1', 'APPENDIX E memoranda')) AS v(d, t)
  UNION ALL SELECT doc_id, 100000000001 + 2 * k, term, 1000000, 10.0, true FROM gl UNION ALL SELECT doc_id, 100000000002 + 2 * k, about, 1000000, 10.0, false FROM gl),
ways AS (SELECT * FROM (VALUES
  ('FIPS-200', '^([A-Z][A-Za-z, /and]+\s\((?:AC|AT|AU|CA|CM|CP|IA|IR|MA|MP|PE|PL|PS|RA|SA|SC|SI)\)):\s*\S', NULL, 99, 'section', 150, 'duplicate_area_stub', '', '', false),
  ('SP-800-37r2', '^TASK\s+([PCSIARM]-\d+)\b', '(?i)^(?:CHAPTER|APPENDIX)\s', 99, 'task', 200, 'duplicate_task_stub', 'TASK ', '', false),
  ('SP-800-60v2r1', '^(D\.\d+(?:\.\d+)*)\s+\S', NULL, 99, 'section', 200, 'duplicate_information_type_stub', '', '', false),
  ('AI-100-1', '^((?:GOVERN|MAP|MEASURE|MANAGE)\s+\d+\.\d+):', NULL, 2, 'ai_rmf_subcategory', 60, 'duplicate_subcategory_stub', '', '', true),
  ('SP-800-218', '^((?:PO|PS|PW|RV)\.\d+(?:\.\d+)?):\s*\S', NULL, 2, 'ssdf_practice', 60, 'duplicate_practice_stub', '', 'SSDF Practices', true),
  ('SP-800-218A', '^((?:PO|PS|PW|RV)\.\d+(?:\.\d+)?):\s*\S', NULL, 2, 'ssdf_practice', 60, 'duplicate_practice_stub', '', 'SSDF Practices', true)) AS v(doc_id, pat, stop, span, ctype, least, stub, label, dotted, settle))"""
#: kb: the blocks that are kept, with their texts; ki, gone: the sections left beside them, and why the others are not.
_TREATED = (
    f"{_DRESSED_SQL}, {_SECTIONS}"
    + rf""",
ea AS (SELECT doc_id, min_by(page, line_no) AS cutoff FROM l WHERE doc_id = 'SP-800-60v2r1' AND regexp_matches({_S}, '(?i)^APPENDIX\s+E\b') AND NOT regexp_matches(text, '\.{{4,}}\s*\d*\s*$') AND NOT EXISTS (SELECT 1 FROM con WHERE con.doc_id = l.doc_id AND con.page = l.page) GROUP BY doc_id),
ev AS (SELECT x.*, w.*, regexp_extract(t, pat, 1) AS ikey, coalesce(level <= span, false) OR coalesce(regexp_matches(t, stop), false) AS closes FROM x JOIN ways w USING (doc_id) LEFT JOIN ea USING (doc_id) WHERE page < coalesce(cutoff, 1e9)),
bl AS (SELECT *, count_if(ikey <> '') OVER w AS block, last_value(CASE WHEN ikey <> '' THEN 'open' WHEN closes THEN 'close' END IGNORE NULLS) OVER w AS state FROM ev WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
fb AS (SELECT doc_id, block, arg_min({{'k': ikey, 'page': page, 'section': section, 'level': level}}, line_no) AS f, list(t ORDER BY line_no) AS lines, any_value(stub) AS stub, any_value(ctype) AS ctype, any_value(least) AS least, any_value(label) AS label, any_value(dotted) AS dotted, any_value(settle) AS settle FROM bl WHERE state = 'open' GROUP BY doc_id, block),
rk AS (SELECT *, f.k AS ikey, f.page AS page, row_number() OVER (PARTITION BY doc_id, f.k ORDER BY length(array_to_string(lines[2:], ' ')) DESC, block) AS place FROM fb),
vo AS (SELECT DISTINCT doc_id, lower(unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z''’-]*'))) AS word FROM l),
pi AS (SELECT doc_id, block, settle, i, ls[i] AS t, ls[i + 1] AS nxt, regexp_extract(ls[i], '([A-Za-z]+)-$', 1) AS a, regexp_extract(ls[i + 1], '^([a-z]+)', 1) AS b FROM (SELECT doc_id, block, settle, list_filter(lines, lambda v: v <> '') AS ls FROM rk WHERE place = 1), unnest(range(1, len(ls) + 1)) AS u(i)),
jo AS (SELECT pi.doc_id, block, string_agg(CASE WHEN nxt IS NULL THEN t WHEN NOT settle OR a = '' OR coalesce(b, '') = '' THEN t || ' ' WHEN vo.word IS NOT NULL THEN t ELSE t[:-2] END, '' ORDER BY i) AS text FROM pi LEFT JOIN vo ON vo.doc_id = pi.doc_id AND vo.word = lower(a) || '-' || b GROUP BY ALL),
ab AS (SELECT doc_id, section, array_to_string(list_filter(list_transform(list_filter(trail, lambda h: NOT regexp_matches(h, {_DROPPED})), lambda h: {_CLEAN.format("h")}), lambda h: h <> ''), ' > ') AS above, {_CLEAN.format("heading")} AS heading FROM sec),
kb AS (SELECT rk.doc_id, ctype, ikey, rk.page, jo.text, least, concat_ws(' > ', nullif(CASE WHEN dotted <> '' THEN array_to_string([dotted, split_part(ikey, '.', 1), array_to_string(string_split(ikey, '.')[:2], '.')], ' > ') WHEN f.level IS NOT NULL THEN above ELSE concat_ws(' > ', nullif(above, ''), nullif(ab.heading, '')) END, ''), label || ikey) AS path
  FROM rk JOIN jo USING (doc_id, block) JOIN ab ON ab.doc_id = rk.doc_id AND ab.section = f.section WHERE place = 1)"""
)
#: Ids given one row after the other, as each looks at all before it.
_NAMED = (
    _PUBLISHED
    + rf""",
nu AS MATERIALIZED (SELECT *, doc_id || '/' || chunk_type || '/' || {_SLUG.format("slug")} AS natural_id, row_number() OVER (PARTITION BY doc_id ORDER BY first_line, slug, text) AS i FROM em),
gv(doc_id, i, id, seen) AS (SELECT DISTINCT doc_id, 0::BIGINT, '', []::VARCHAR[] FROM nu
  UNION ALL SELECT doc_id, i, id, list_append(seen, id) FROM (SELECT nu.doc_id, nu.i, gv.seen, CASE WHEN list_contains(gv.seen, natural_id) THEN natural_id || '-' || list_filter(range(2, len(gv.seen) + 3), lambda k: NOT list_contains(gv.seen, natural_id || '-' || k))[1] ELSE natural_id END AS id FROM gv JOIN nu ON nu.doc_id = gv.doc_id AND nu.i = gv.i + 1))
SELECT nu.doc_id, gv.id, chunk_type, md5(text) AS md5, section_path, page FROM nu JOIN gv USING (doc_id, i)"""
)
_BODY = f"WITH {_LINES}, {_sized('b', 'l')}"
ORACLES = {
    "impact_table": """WITH o AS (SELECT CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 3 ELSE 1 END AS k, CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 'HIGH' WHEN left(o_orderpriority, 1) = '3' THEN 'MODERATE' ELSE 'LOW' END AS level FROM orders),
n AS (SELECT k, name, definition, level, l, (SELECT count(*) FROM o WHERE o.k = v.k AND o.level = w.level) AS n FROM (VALUES (1, 'Availability', 'being there'), (2, 'Confidentiality', 'keeping'), (3, 'Integrity', NULL)) AS v(k, name, definition), (VALUES (1, 'LOW'), (2, 'MODERATE'), (3, 'HIGH')) AS w(l, level)),
t AS (SELECT k, 0 AS l, name || ' (definition): ' || definition AS line FROM n WHERE l = 1 AND definition IS NOT NULL UNION ALL SELECT k, l, name || ' / ' || level || ': n = ' || n FROM n)
SELECT string_agg(line, chr(10) ORDER BY k, l) AS text FROM t""",
    "body_sizes": _BODY + " SELECT * FROM b",
    "span_lines": f"WITH {_LINES}"
    + r""", w AS (SELECT *, list_sort(list_transform(list_filter(string_split(text, ' '), lambda w: regexp_replace(w, '\s', '', 'g') <> ''), lambda w, i: {'n': -length(w), 'i': i}))[1].n * -1 AS n FROM l)
SELECT doc_id, line_no, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text, page, CASE (n % 7)::INT WHEN 0 THEN 8.2 WHEN 1 THEN 9.2 WHEN 2 THEN 10.2 WHEN 3 THEN 11.2 WHEN 4 THEN 12.2 WHEN 5 THEN 13.2 ELSE 14.2 END::DOUBLE AS size, n > 6 AS bold, round_even(i - 1 + 0.25, 1)::DOUBLE AS y FROM (SELECT w.*, line_no % 100000 + 1 AS i FROM w) WHERE n IS NOT NULL""",
    "repeating_lines": f"WITH {_PRINTED}, {_content('pl')} SELECT * FROM rep",
    "contents": f"WITH {_PRINTED}, {_content('pl')} SELECT * FROM con",
    "content_lines": f"WITH {_PRINTED}, {_content('pl')} SELECT doc_id, line_no, page FROM ct",
    "heading_levels": f"{_BODY}, {_levelled('lv', 'l', 'b')} SELECT doc_id, line_no, level FROM lv WHERE level IS NOT NULL",
    "sections": _SECTIONED + " SELECT doc_id, section, level, page, heading, array_to_string(trail, ' > ') AS trail, len(body)::INT AS lines, md5(array_to_string(body, chr(10))) AS md5 FROM sec",
    "longest_blocks": _SECTIONED
    + r""", ev AS (SELECT *, regexp_matches(t, '^[a-z0-9]{1,3}[.)]\s') AS opens, coalesce(level <= 1, false) AS closes FROM x),
bl AS (SELECT *, count_if(opens) OVER w AS block, last_value(CASE WHEN opens THEN 'open' WHEN closes THEN 'close' END IGNORE NULLS) OVER w AS state FROM ev WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
gb AS (SELECT doc_id, block, min_by(regexp_extract(t, '^([a-z0-9]{1,3})[.)]\s', 1), line_no) AS key, length(array_to_string(list(t ORDER BY line_no)[2:], ' ')) AS n FROM bl WHERE state = 'open' GROUP BY doc_id, block)
SELECT doc_id, key, block, row_number() OVER (PARTITION BY doc_id, key ORDER BY n DESC, block) = 1 AS kept FROM gb""",
    "publication_rows": _NAMED,
    "treated_rows": _TREATED
    + r""" SELECT doc_id, ctype AS chunk_type, ikey AS slug, md5(text) AS md5, path AS section_path, page FROM kb WHERE length(text) >= least
UNION ALL SELECT doc_id, 'definition', term, md5(term || ': ' || about), 'APPENDIX > GLOSSARY > ' || term, NULL FROM gl WHERE length(term || ': ' || about) >= 40
UNION ALL SELECT 'FIPS-199', 'table', 'table-1-potential-impact-definitions', md5('Table 1: Potential Impact Definitions for Security Objectives (FIPS 199).' || chr(10) || 'The potential impact on each security objective, by impact level:' || chr(10) || chr(10) || text), 'Table 1 > Potential Impact Definitions for Security Objectives', 1000000 FROM (@IMPACT@)""",
    "publication_rejections": _PUBLISHED + " SELECT doc_id, rule, count(*) AS n FROM rj GROUP BY ALL",
    "section_trails": """WITH e AS (SELECT 'u' || (user_id % 50) AS doc_id, event_id AS line_no, (length(event_type) % 3 + 1)::INT AS level FROM events),
w AS (SELECT *, count(*) OVER o AS section, max(CASE WHEN level = 1 THEN line_no END) OVER p AS p1, max(CASE WHEN level = 2 THEN line_no END) OVER p AS p2 FROM e
WINDOW o AS (PARTITION BY doc_id ORDER BY line_no), p AS (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
d AS (SELECT *, level > 1 AND p1 IS NOT NULL AS h1, level > 2 AND p2 IS NOT NULL AND p2 > coalesce(p1, -1) AS h2 FROM w)
SELECT doc_id, line_no, level, section, (h1::INT + h2::INT)::INT AS depth, CASE WHEN h2 THEN '1.1 head ' || p2 WHEN h1 THEN '1 head ' || p1 END AS parent FROM d""",
    "dehyphenated": r"""WITH c AS (SELECT row_no, doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS l FROM chunks WHERE doc_id IS NOT NULL),
v AS (SELECT DISTINCT doc_id, lower(unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z''’-]*'))) AS word FROM chunks WHERE doc_id IS NOT NULL),
p AS (SELECT row_no, doc_id, i, l[i] AS t, l[i + 1] AS nxt FROM c, unnest(range(1, len(l) + 1)) AS u(i)),
h AS (SELECT *, regexp_extract(t, '([A-Za-z]+)-$', 1) AS a, regexp_extract(nxt, '^([a-z]+)', 1) AS b FROM p),
s AS (SELECT h.row_no, i, CASE WHEN nxt IS NULL THEN t WHEN a = '' OR b = '' THEN t || ' ' WHEN v.word IS NOT NULL THEN t ELSE t[:-2] END AS piece FROM h LEFT JOIN v ON v.doc_id = h.doc_id AND v.word = lower(a) || '-' || b)
SELECT row_no, coalesce(string_agg(piece, '' ORDER BY i), '') AS text FROM c LEFT JOIN s USING (row_no) GROUP BY row_no""",
    "definitions": r"""WITH l AS (SELECT doc_id, row_no * 100000 + i - 1 AS line_no, regexp_replace(t[i], '^\s+|\s+$', '', 'g') AS t FROM (SELECT doc_id, row_no, string_split(text, chr(10)) AS t FROM chunks WHERE doc_id IS NOT NULL), unnest(range(1, len(t) + 1)) AS u(i)),
s AS (SELECT *, regexp_matches(t, '^[A-Z][A-Za-z0-9()/,''’\- ]{2,70}?\s*[:–—]\s+[A-Z(\[][^\n]*$') AS st FROM l), e AS (SELECT *, sum(CASE WHEN st THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS entry FROM s),
g AS (SELECT doc_id, entry, min(line_no) AS first_line, regexp_replace(max(CASE WHEN st THEN regexp_extract(t, '^([A-Z][A-Za-z0-9()/,''’\- ]{2,70}?)\s*[:–—]\s+[A-Z(\[]', 1) END), '\s+', ' ', 'g') AS term, string_agg(CASE WHEN st THEN regexp_extract(t, '^[A-Z][A-Za-z0-9()/,''’\- ]{2,70}?\s*[:–—]\s+([A-Z(\[][^\n]*)$', 1) ELSE t END, ' ' ORDER BY line_no) AS body FROM e WHERE entry > 0 GROUP BY doc_id, entry)
SELECT doc_id, first_line, term, length(term || ': ' || regexp_replace(body, '^\s+|\s+$', '', 'g'))::INT AS chars FROM g""",
}
ORACLES["treated_rows"] = ORACLES["treated_rows"].replace("@IMPACT@", ORACLES["impact_table"])
#: Front matter goes first, then the appendix, then what blocks cover, then glossaries told by type; the rest are sections.
ORACLES["treated_rejections"] = (
    _TREATED
    + _EMITTED.replace("kp AS (SELECT fr.doc_id", "kp0 AS (SELECT fr.doc_id", 1).replace(
        "sp AS (SELECT *,",
        """kp AS (SELECT * FROM kp0 k WHERE NOT EXISTS (SELECT 1 FROM ea WHERE ea.doc_id = k.doc_id AND k.page >= cutoff) AND NOT EXISTS (SELECT 1 FROM kb WHERE kb.doc_id = k.doc_id AND kb.page = k.page) AND NOT EXISTS (SELECT 1 FROM ways w WHERE w.doc_id = k.doc_id AND regexp_matches(k.heading, pat))
  AND NOT (k.doc_id IN ('SP-800-37r2', 'SP-800-137') AND k.page = 1000000)),
sp AS (SELECT *,""",
        1,
    )
    + """ SELECT doc_id, rule, count(*) AS n FROM (SELECT * FROM rj
UNION ALL SELECT k.doc_id, 'excluded_appendix' FROM kp0 k JOIN ea ON ea.doc_id = k.doc_id AND k.page >= cutoff
UNION ALL SELECT doc_id, stub FROM rk WHERE place > 1 UNION ALL SELECT doc_id, 'block_too_short' FROM kb WHERE length(text) < least
UNION ALL SELECT k.doc_id, 'covered_by_block' FROM kp0 k JOIN ways w USING (doc_id) WHERE EXISTS (SELECT 1 FROM kb WHERE kb.doc_id = k.doc_id AND kb.page = k.page) AND NOT regexp_matches(k.heading, pat) AND NOT EXISTS (SELECT 1 FROM ea WHERE ea.doc_id = k.doc_id AND k.page >= cutoff)
UNION ALL SELECT doc_id, 'definition_too_short' FROM gl WHERE length(term || ': ' || about) < 40) GROUP BY ALL"""
)
