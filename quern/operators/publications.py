"""Whole publications as rows: which treatment each document gets is a table, not code."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import layout, ordered
from quern.session import stored


@dataclass(frozen=True)
class Treatment:
    """How documents of one kind are read. Everything may be absent; then sections and glossaries by punctuation remain.

    block: pattern of identifier lines, the key being group 1; stop and span end blocks. glossary: title of an appendix
    whose terms are told by type. excluded: pattern of an appendix that is left out from its first line on. table:
    pattern of the pages that hold the impact table.
    """

    documents: tuple[str, ...] = ()
    block: str | None = None
    stop: str | None = None
    span: int = 99
    chunk_type: str = "section"
    min_chars: int = 120
    stub_rule: str = "duplicate_stub"
    label: str = ""
    dotted_path: str = ""
    settle_hyphens: bool = False
    glossary: str | None = None
    excluded: str | None = None
    table: str | None = None


#: Treatments of known publications (fixed values).
TREATMENTS = (
    Treatment(("FIPS-199",), table=r"(?i)TABLE 1:\s*POTENTIAL IMPACT DEFINITIONS"),
    Treatment(("FIPS-200",), block=r"^([A-Z][A-Za-z, /and]+\s\((?:AC|AT|AU|CA|CM|CP|IA|IR|MA|MP|PE|PL|PS|RA|SA|SC|SI)\)):\s*\S", min_chars=150, stub_rule="duplicate_area_stub"),
    Treatment(("SP-800-37r2",), block=r"^TASK\s+([PCSIARM]-\d+)\b", stop=r"(?i)^(?:CHAPTER|APPENDIX)\s", chunk_type="task", min_chars=200, stub_rule="duplicate_task_stub", label="TASK ", glossary="GLOSSARY"),
    Treatment(("SP-800-60v2r1",), block=r"^(D\.\d+(?:\.\d+)*)\s+(?=\S)", min_chars=200, stub_rule="duplicate_information_type_stub", excluded=r"(?i)^APPENDIX\s+E\b"),
    Treatment(("SP-800-137",), glossary="GLOSSARY"),
    Treatment(("AI-100-1",), block=r"^((?:GOVERN|MAP|MEASURE|MANAGE)\s+\d+\.\d+):", span=2, chunk_type="ai_rmf_subcategory", min_chars=60, stub_rule="duplicate_subcategory_stub", settle_hyphens=True),
    Treatment(("SP-800-218", "SP-800-218A"), block=r"^((?:PO|PS|PW|RV)\.\d+(?:\.\d+)?):\s*\S", span=2, chunk_type="ssdf_practice", min_chars=60, stub_rule="duplicate_practice_stub", dotted_path="SSDF Practices", settle_hyphens=True),
)
_ROW = ("doc_id", "chunk_type", "slug", "text", "section_path", "first_line", "page")
#: Order of emission of a document's rows: blocks, terms told by type, sections with their definitions, tables.
BLOCKS, TERMS, SECTIONS, DEFINITIONS, TABLES = range(5)


def _emitted(rows: DataFrame, part: int) -> DataFrame:
    return rows.select(*_ROW, F.lit(part).alias("part"))


def _plain(found: DataFrame, marked: DataFrame, definitions: int = SECTIONS) -> tuple[list[DataFrame], list[DataFrame]]:
    """Sections as they are, but sections under a glossary heading as definitions, which may come after them all."""
    glossary = F.col("heading").rlike(layout.GLOSSARY)
    rows, short = layout.emit_sections(found.where(~glossary))
    inside = found.where(glossary).select("doc_id", "section", layout._path().alias("_path"))
    lines = marked.where("level IS NULL").select("doc_id", "section", "line_no", "text", "page", "_range").join(inside, ["doc_id", "section"])
    entries = layout.extract_definitions(lines, ["doc_id", "section"]).join(inside, ["doc_id", "section"])
    good = entries.where(F.length("text") >= 40).select("doc_id", F.lit("definition").alias("chunk_type"), F.col("term").alias("slug"), "text", F.concat_ws(" > ", "_path", "term").alias("section_path"), "first_line", F.lit(None).cast("int").alias("page"))
    return [_emitted(rows, SECTIONS), _emitted(good, definitions)], [short, layout._rejection(entries.where(F.length("text") < 40), F.col("term"), "definition_too_short", F.concat(F.length("text").cast("string"), F.lit(" chars")))]


def _treated(lines: DataFrame, found: DataFrame, marked: DataFrame, how: Treatment, grids: DataFrame | None) -> tuple[list[DataFrame], list[DataFrame]]:
    rows: list[DataFrame] = []
    rejected: list[DataFrame] = []
    if how.excluded:
        start = layout.excluded_from(lines, how.excluded).withColumnRenamed("page", "_from")
        joined = found.join(start, "doc_id", "left")
        beyond = F.coalesce(F.col("page") >= F.col("_from"), F.lit(False))
        rejected.append(layout._rejection(joined.where(beyond), F.concat(F.lit("p"), F.col("page").cast("string"), F.lit(":"), F.substring(layout.clean_heading(F.col("heading")), 1, 60)), "excluded_appendix", F.concat(F.lit("from page "), F.col("_from").cast("string"))))
        found = joined.where(~beyond).drop("_from")
        marked = marked.join(start, "doc_id", "left").where(~F.coalesce(F.col("page") >= F.col("_from"), F.lit(False))).drop("_from")
    if how.block:
        blocks = stored(layout.extract_blocks(marked, how.block, how.stop, how.span), "blocks")
        kept, stubs = layout.keep_longest(blocks)
        rejected.append(layout._rejection(stubs, F.col("key"), how.stub_rule, F.concat(F.lit("shorter duplicate on page "), F.col("page").cast("string"))))
        path: Column | None = None
        if how.dotted_path:
            parts = F.split("key", r"\.")
            path = F.array_join(F.slice(F.array(F.lit(how.dotted_path), F.get(parts, 0), F.concat_ws(".", F.slice(parts, 1, 2))), 1, 3), " > ")
        label = F.concat(F.lit(how.label), F.col("key")) if how.label else None
        shaped, small = layout.emit_blocks(kept, how.chunk_type, how.min_chars, label, path, layout.vocabulary(lines) if how.settle_hyphens else None)
        if how.chunk_type == "task":
            # Tasks come in the order of their letters and numbers.
            key = T.task_sort_key(F.col("slug"))
            shaped = shaped.withColumn("first_line", F.ascii(key["letter"]).cast("bigint") * 10_000_000_000 + key["number"])
        rows.append(_emitted(shaped, BLOCKS))
        rejected.append(small)
        # What shares a page with a kept block is covered by it, and that is logged.
        on_page = kept.select("doc_id", "page").distinct()
        covered = found.join(on_page, ["doc_id", "page"], "left_semi").where(~F.col("heading").rlike(how.block))
        rejected.append(layout._rejection(covered, layout.clean_heading(F.col("heading")), "covered_by_block", F.concat(F.lit("page "), F.col("page").cast("string"))))
        found = found.join(on_page, ["doc_id", "page"], "left_anti").where(~F.col("heading").rlike(how.block))
    if how.glossary:
        spans = layout.appendix_spans(lines, how.glossary)
        entries = layout.term_definitions(lines, spans)
        rows.append(_emitted(entries.where(F.length("text") >= 40).select("doc_id", F.lit("definition").alias("chunk_type"), F.col("term").alias("slug"), "text", F.concat(F.lit(f"APPENDIX > {how.glossary} > "), "term").alias("section_path"), "first_line", F.lit(None).cast("int").alias("page")), TERMS))
        rejected.append(layout._rejection(entries.where(F.length("text") < 40), F.col("term"), "definition_too_short", F.concat(F.length("text").cast("string"), F.lit(" chars"))))
        without = lines.select("doc_id").distinct().join(spans.select("doc_id"), "doc_id", "left_anti")
        rejected.append(layout._rejection(without, F.lit(how.glossary), "glossary_not_found", F.lit("no such title in display type")))
        within = found.join(spans, "doc_id", "left").where(~F.coalesce(F.col("page").between(F.col("first"), F.col("last")), F.lit(False)))
        found = within.drop("first", "last")
    if how.table:
        page = layout.pages_containing(lines, how.table).groupBy("doc_id").agg(F.max("page").alias("page"))
        documents = lines.select("doc_id").distinct()
        rejected.append(layout._rejection(documents.join(page, "doc_id", "left_anti"), F.lit("Table 1"), "table_not_found", F.lit("no line names the table")))
        cells = grids if grids is not None else page.select("doc_id", "page", F.array().cast("array<array<string>>").alias("grid")).where("false")
        read = page.join(cells, ["doc_id", "page"], "left").withColumn("t", layout.transcribe_impact_table(layout.trim_grid(F.col("grid"))))
        intro = "Table 1: Potential Impact Definitions for Security Objectives (FIPS 199).\nThe potential impact on each security objective, by impact level:\n\n"
        rows.append(_emitted(read.where("t IS NOT NULL").select("doc_id", F.lit("table").alias("chunk_type"), F.lit("table-1-potential-impact-definitions").alias("slug"), F.concat(F.lit(intro), "t").alias("text"), F.lit("Table 1 > Potential Impact Definitions for Security Objectives").alias("section_path"), F.lit(None).cast("long").alias("first_line"), "page"), TABLES))
        rejected.append(layout._rejection(read.where("t IS NULL"), F.lit("Table 1"), "extraction_failure", F.lit("no usable grid")))
    more, less = _plain(found, marked, DEFINITIONS if how.table else SECTIONS)
    return rows + more, rejected + less


def parse_publications(lines: DataFrame, grids: DataFrame | None = None, treatments: tuple[Treatment, ...] = TREATMENTS) -> tuple[DataFrame, DataFrame]:
    """(rows, rejections) of laid-out documents. rows: doc_id, chunk_type, slug, text, section_path,
    first_line, page, part (with first_line the order of emission); `identified` gives them their ids.

    `grids` (doc_id, page, grid) holds tables. Documents of no treatment are read as sections and glossaries. Front
    matter is dropped with one rejection for each document. A document without lines gives nothing.
    """
    lines = ordered.ranged(lines, layout.KEY, "line_no", "lines")
    marked = stored(layout.sectioned(lines), "sectioned")
    found, front = layout.drop_front_matter(stored(layout.gathered(marked), "sections"), layout.body_start_pages(lines))
    rows, rejected = [], [front]
    listed = [d for t in treatments for d in t.documents]
    present = {r[0] for r in lines.select("doc_id").where(F.col("doc_id").isin(*listed)).distinct().collect()} if listed else set()
    for how, mine in [*((t, F.col("doc_id").isin(*t.documents)) for t in treatments), (Treatment(), ~F.col("doc_id").isin(*listed) if listed else F.lit(True))]:
        if how.documents and not present.intersection(how.documents):
            continue
        more, less = _treated(lines.where(mine), found.where(mine), marked.where(mine), how, grids)
        rows, rejected = rows + more, rejected + less

    def united(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    return united(rows), united(rejected)



def identified(rows: DataFrame) -> DataFrame:
    """The rows of `parse_publications` with `id`, repeated ones numbered in the order of emission."""
    made = stored(rows, "emitted")
    return layout.with_ids(made.withColumn("seq", F.struct("part", "first_line", "slug", F.xxhash64("text", "section_path")))).drop("seq")
