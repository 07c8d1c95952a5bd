"""Documents laid out in lines: furniture, headings, sections, glossaries, blocks by identifier, tables.

Everything works on the relation of lines (doc_id, line_no, text, page, size, bold, y), for any number of documents at
once. Order within a document is line_no. What a sequential reader would keep in variables are running sums and carried
values over it (see `ordered`), which never gather a document in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import ordered
from quern.session import stored

# Patterns on which results depend.
PAGE_NUMBER = r"(?i:^(?:page\s+)?[ivxlcdm\d]+(?:\s+of\s+\d+)?\z)"
RULE = r"^[_\-=–—\s]{6,}\z"
LEADERS = r"\.{4,}\s*\d*\s*\z"
BOILERPLATE = (
    r"(?i:this publication is available free of charge)", r"(?i:^https?://(?:dx\.)?doi\.org/)", r"(?i:^\s*NIST (?:Special Publication|SP)\s+[\d\-.A-Za-z]+\s*\z)",
    r"(?i:national institute of standards and technology)", r"(?i:u\.s\. department of commerce)",
)
CONTENTS_ENTRY = r"(?i)^\S[^\n]{2,90}?[\s.]+(?:\d{1,3}|[ivxl]{1,6})\z"
NUMBERED = r"^(\d+(?:\.\d+)*)\s+\S"
KEYWORD = r"(?i)^(CHAPTER|APPENDIX|ANNEX|SECTION|TASK)\s+[A-Z0-9][-A-Z0-9.]*\s*:?"
LETTERED = r"^([A-Z](?:\.\d+)+)\s+\S"
BULLET = r"^[•▪◦○*·–—-]\s"
OPEN_WORDS = ("and", "or", "the", "of", "to", "a", "an", "for", "with", "in")
KEPT_FRONT = r"(?i)^(?:executive summary|abstract)\b"
DROPPED_ANCESTOR = r"(?i)(?:gaithersburg|submit comments|trademark|patent disclosure|^abstract\z|^keywords\z|^acknowledg|^disclaimer|^audience\z|bureau drive|attn:|^certain commercial)"
GLOSSARY = r"(?i)(?:terms and definitions|glossary|appendix\s+[a-z]\s*[-—:]?\s*(?:glossary|terms))"
DEFINITION = r"^([A-Z][A-Za-z0-9()/,'’\- ]{2,70}?)\s*[:–—]\s+([A-Z(\[][^\n]*)\z"
SOURCE_LINE = r"^\[[^\]]{2,}"
HEADER_ONLY = r"(?i)^(?:APPENDIX|CHAPTER|PAGE)\s+[A-Za-z0-9-]{1,10}\z"

KEY = ["doc_id"]


def furniture_key(text: Column) -> Column:
    """A line without what changes from page to page: case, spacing and digits."""
    return _furniture_key(T.strip(text))


def _furniture_key(stripped: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(stripped), r"(?U)\s+", " "), r"\d+", "#")


def _stripped(lines: DataFrame) -> DataFrame:
    """Lines with `_t`, the text without white space at its ends, so that it is stripped once."""
    return lines if "_t" in lines.columns else lines.withColumn("_t", T.strip(F.col("text")))


def clean_heading(text: Column) -> Column:
    return T.strip(F.regexp_replace(text, r"(?U)\s+", " "))


def page_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*KEY).agg(F.coalesce(F.max("page"), F.lit(1)).alias("pages"))


def body_font_size(lines: DataFrame) -> DataFrame:
    """The size of most characters of each document; of equal ones that which comes first. 10 for a document without any."""
    sizes = lines.groupBy(*KEY, "size").agg(F.sum(F.length("text")).alias("w"), F.min("line_no").alias("first"))
    return sizes.groupBy(*KEY).agg(F.coalesce(F.max_by("size", F.struct("w", -F.col("first"))), F.lit(10.0)).alias("body_size"))


def repeating_furniture(lines: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, key of lines on more than half of the pages of their document, but on three at least."""
    keys = _stripped(lines).where(F.length("_t") >= 3).withColumn("key", _furniture_key(F.col("_t")))
    pages = keys.groupBy(*KEY, "key").agg(F.countDistinct("page").alias("on"))
    return pages.join(page_counts(lines), KEY).where(F.col("on") > F.greatest(F.lit(2), F.floor(F.col("pages") * threshold))).select(*KEY, "key")


def contents_pages(lines: DataFrame, entries: int = 5) -> DataFrame:
    """doc_id, page of tables of contents: early pages with five lines that end in a page number."""
    early = _stripped(lines).join(page_counts(lines), KEY).where(F.col("page") <= F.greatest(F.lit(3), F.floor(F.col("pages") * 0.2)))
    return early.where(F.col("_t").rlike(CONTENTS_ENTRY)).groupBy(*KEY, "page").agg(F.count("*").alias("n")).where(F.col("n") >= entries).select(*KEY, "page")


def without_furniture(lines: DataFrame) -> DataFrame:
    """Lines that are content: not blank, no rule, page number, leader, boilerplate, repeating line or contents page."""
    # One pattern for all, so that a line is stripped and read once.
    plain = "|".join(f"(?:{p})" for p in (r"^\z", RULE, PAGE_NUMBER, LEADERS, *BOILERPLATE))
    shaped = _stripped(lines)
    kept = shaped.where(~F.col("_t").rlike(plain)).withColumn("key", _furniture_key(F.col("_t")))
    return kept.join(repeating_furniture(shaped), [*KEY, "key"], "left_anti").join(contents_pages(shaped), [*KEY, "page"], "left_anti").select(*lines.columns)


def _is_upper(text: Column) -> Column:
    return (F.upper(text) == text) & text.rlike(r"\p{L}")


def heading_level(text: Column, size: Column, bold: Column, body_size: Column) -> Column:
    """Depth of a line as a heading, null for body text. Numbers are trusted first; type decides where there are none."""
    return _heading_level(T.strip(text), size, bold, body_size)


def _heading_level(t: Column, size: Column, bold: Column, body_size: Column) -> Column:
    keyword, upper = t.rlike(KEYWORD), _is_upper(t)
    depth = lambda pattern: F.length(F.regexp_replace(F.regexp_extract(t, pattern, 1), r"[^.]", "")) + 1
    last_word = F.regexp_replace(F.lower(F.substring_index(t, " ", -1)), "^[,;:]+|[,;:]+\\z", "")
    body_like = t.rlike(BULLET) | t.rlike(r"[,;]\z") | last_word.isin(*OPEN_WORDS)
    return (
        F.when((t == "") | (F.length(t) > 160) | (F.length(t) == 1), None)
        .when(t.rlike(r"[.;]\z") & ~upper & ~keyword, None)
        .when(t.rlike(NUMBERED) & (F.length(t) <= 120) & (size + 0.2 >= body_size), depth(NUMBERED))
        .when(keyword, F.when(F.upper(F.regexp_extract(t, KEYWORD, 1)) == "TASK", 3).otherwise(1))
        .when(t.rlike(LETTERED), depth(LETTERED))
        .when((F.length(t) <= 80) & ~t.endswith(".") & ~body_like, F.when(size >= body_size + 1.0, 2).when((bold | upper) & (size >= body_size), 3))
        .cast("int")
    )


def with_levels(lines: DataFrame) -> DataFrame:
    """Lines with body_size and level. One row for each document is joined on; the planner broadcasts it while small."""
    shaped = _stripped(lines).join(body_font_size(lines), KEY)
    return shaped.withColumn("level", _heading_level(F.col("_t"), F.col("size"), F.coalesce("bold", F.lit(False)), F.col("body_size"))).select(*lines.columns, "body_size", "level")


def sectioned(lines: DataFrame) -> DataFrame:
    """Content lines with section (its number in the document, 0 before the first heading), level of a heading line, and
    trail (the headings above the section's own, outermost first) with the section's heading.

    The last heading of level k above a line is an ancestor if no higher heading stands between them: no stack is needed.
    """
    content = stored(with_levels(without_furniture(ordered.ranged(lines, KEY, "line_no", "lines"))), "content")
    # A number of a hundred signs has fifty levels at most; usual ones have few, and there are as many columns.
    deepest = content.agg(F.max("level")).first()[0] or 0
    place = F.struct("line_no", T.strip(F.col("text")).alias("heading"), "level")
    carry = {"_head": F.when(F.col("level").isNotNull(), place)} | {f"_a{k}": F.when(F.col("level") == k, place) for k in range(1, deepest)}
    met = ordered.along(content, KEY, "line_no", {"section": F.when(F.col("level").isNotNull(), 1).otherwise(0)}, carry)
    trail = []
    for k in range(1, deepest):
        higher = F.greatest(*[F.coalesce(F.col(f"_a{j}.line_no"), F.lit(-1)) for j in range(1, k)], F.lit(-1), F.lit(-1))
        trail.append(F.when((F.col("_head.level") > k) & (F.col(f"_a{k}.line_no") > higher), F.col(f"_a{k}.heading")))
    above = F.array_compact(F.array(*trail)) if trail else F.array().cast("array<string>")
    return met.select(*content.columns, "section", F.coalesce("_head.level", F.lit(0)).alias("section_level"), F.coalesce("_head.heading", F.lit("")).alias("heading"), above.alias("trail"))


def body_start_pages(lines: DataFrame) -> DataFrame:
    """doc_id, start: the page of the first section 1 or chapter, 1 where that comes after the first third."""
    marked = with_levels(lines).join(contents_pages(lines), [*KEY, "page"], "left_anti")
    text = T.strip(F.col("text"))
    first = marked.where((F.col("level") == 1) & ((F.regexp_extract(text, NUMBERED, 1) == "1") | text.rlike(r"(?i)^(?:CHAPTER|SECTION)\s"))).groupBy(*KEY).agg(F.min_by("page", "line_no").alias("page"))
    joined = page_counts(lines).join(first, KEY, "left")
    return joined.select(*KEY, F.when(F.col("page") <= F.greatest(F.lit(3.0), F.col("pages") * 0.33), F.col("page")).otherwise(1).alias("start"))


def sections(lines: DataFrame) -> DataFrame:
    """One row for each section: doc_id, section, level, page, heading, trail, body (its lines), first_line.

    A section is gathered in one row, so its size is that of a printed section.
    """
    return gathered(sectioned(lines))


def gathered(marked: DataFrame) -> DataFrame:
    """The sections of lines that have been sectioned."""
    entry = F.when(F.col("level").isNull(), F.struct("line_no", T.strip(F.col("text")).alias("t")))
    grouped = marked.groupBy(*KEY, "section").agg(
        F.max("section_level").alias("level"), F.min("page").alias("page"), F.max("heading").alias("heading"), F.max("trail").alias("trail"), F.min("line_no").alias("first_line"), F.array_sort(F.collect_list(entry)).alias("_l")
    )
    return grouped.select(*KEY, "section", "level", "page", "heading", "trail", "first_line", F.transform("_l", lambda x: x["t"]).alias("lines"))


def drop_front_matter(found: DataFrame, starts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sections from the body on, rejections): one rejection for each document says what was dropped before its start."""
    joined = found.join(starts, KEY)
    gone = (F.col("page") < F.col("start")) & ~F.col("heading").rlike(KEPT_FRONT)
    dropped = joined.where(gone)
    summary = dropped.groupBy(*KEY).agg(F.count("*").alias("n"), F.first("start").alias("s"))
    # A dropped heading is no ancestor of anything that stays.
    names = dropped.select(*KEY, F.col("heading").alias("ancestor")).distinct()
    kept = joined.where(~gone)
    trails = kept.select(*KEY, "section", F.posexplode("trail").alias("place", "ancestor")).join(names, [*KEY, "ancestor"], "left_anti")
    trails = trails.groupBy(*KEY, "section").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "ancestor"))), lambda x: x["ancestor"]).alias("_trail"))
    met = kept.join(trails, [*KEY, "section"], "left").withColumn("trail", F.coalesce("_trail", F.array().cast("array<string>")))
    detail = F.concat(F.lit("dropped "), F.col("n").cast("string"), F.lit(" section(s) before page "), F.col("s").cast("string"))
    rejected = summary.select("doc_id", F.concat(F.lit("pages 1-"), (F.col("s") - 1).cast("string")).alias("ref"), F.lit("front_matter").alias("rule"), detail.alias("detail"), F.lit("parse_pdf").alias("stage"))
    return met.select(*found.columns), rejected


def _path() -> Column:
    kept = F.filter("trail", lambda h: ~h.rlike(DROPPED_ANCESTOR))
    return F.array_join(F.filter(F.transform(F.array_append(kept, F.col("heading")), clean_heading), lambda h: h != ""), " > ")


def _rejection(df: DataFrame, ref: Column, rule: str, detail: Column) -> DataFrame:
    return df.select("doc_id", ref.alias("ref"), F.lit(rule).alias("rule"), detail.alias("detail"), F.lit("parse_pdf").alias("stage"))


def emit_sections(found: DataFrame, min_chars: int = 40) -> tuple[DataFrame, DataFrame]:
    """(rows, rejections): a row for each section of at least `min_chars`; slug is its heading, or its page."""
    heading, body = clean_heading(F.col("heading")), T.strip(F.array_join("lines", "\n"))
    shaped = found.withColumn("_h", heading).withColumn("_b", body)
    text = F.when((F.col("_h") != "") & (F.col("_b") != ""), F.concat("_h", F.lit("\n\n"), "_b")).otherwise(F.concat("_h", "_b"))
    shaped = shaped.withColumn("text", text).withColumn("_n", F.length(T.strip(F.col("text"))))
    slug = F.when(T.slugify(F.col("_h")) != "", F.col("_h")).otherwise(F.concat(F.lit("page-"), F.col("page").cast("string")))
    rows = shaped.where(F.col("_n") >= min_chars).select("doc_id", F.lit("section").alias("chunk_type"), slug.alias("slug"), "text", _path().alias("section_path"), "first_line", "page")
    ref = F.concat(F.lit("p"), F.col("page").cast("string"), F.lit(":"), F.substring("_h", 1, 60))
    return rows, _rejection(shaped.where(F.col("_n") < min_chars), ref, "section_too_short", F.concat(F.col("_n").cast("string"), F.lit(" chars")))


def extract_definitions(lines: DataFrame, key: list[str] | None = None) -> DataFrame:
    """key, term, text, first_line: entries of a glossary whose terms end in a colon or dash. Lines before the first are left out."""
    key = key or KEY
    text = T.strip(F.col("text"))
    starts = lines.withColumn("_t", text).withColumn("_start", F.col("_t").rlike(DEFINITION))
    numbered = ordered.along(starts, key, "line_no", {"entry": F.col("_start").cast("int")}).where("entry > 0")
    term = F.max(F.when(F.col("_start"), clean_heading(F.regexp_extract("_t", DEFINITION, 1))))
    part = F.struct("line_no", F.when(F.col("_start"), F.regexp_extract("_t", DEFINITION, 2)).otherwise(F.col("_t")).alias("p"))
    grouped = numbered.groupBy(*key, "entry").agg(term.alias("term"), F.array_sort(F.collect_list(part)).alias("_p"), F.min("line_no").alias("first_line"))
    return grouped.select(*key, "term", F.concat("term", F.lit(": "), T.strip(F.array_join(F.transform("_p", lambda x: x["p"]), " "))).alias("text"), "first_line")


def extract_blocks(lines: DataFrame, pattern: str, stop: str | None = None, max_span_level: int = 99) -> DataFrame:
    """doc_id, block, key, heading, page, path, lines: spans that each start at an identifier line.

    `lines` come from `sectioned`. Group 1 of `pattern` is the key. A block ends at the next one, at a line that matches
    `stop`, and at a heading of level `max_span_level` or above.
    """
    text = T.strip(F.col("text"))
    opens = text.rlike(pattern)
    closes = (F.col("level") <= max_span_level) | (text.rlike(stop) if stop else F.lit(False))
    event = F.when(opens, "open").when(F.coalesce(closes, F.lit(False)), "close")
    marked = lines.withColumn("_text", text).withColumn("_event", event)
    numbered = ordered.along(marked, KEY, "line_no", {"block": F.when(F.col("_event") == "open", 1).otherwise(0)}, {"state": F.col("_event")}).where("state = 'open'")
    trail = F.array_join(F.filter(F.transform(F.filter("trail", lambda h: ~h.rlike(DROPPED_ANCESTOR)), clean_heading), lambda h: h != ""), " > ")
    # An identifier that is itself the heading would otherwise be in its own path.
    path = F.when(F.col("level").isNotNull(), trail).otherwise(F.concat_ws(" > ", F.nullif(trail, F.lit("")), F.nullif(clean_heading(F.col("heading")), F.lit(""))))
    first = F.min(F.struct("line_no", F.regexp_extract("_text", pattern, 1).alias("key"), F.col("_text").alias("heading"), "page", path.alias("path")))
    grouped = numbered.groupBy(*KEY, "block").agg(first.alias("f"), F.array_sort(F.collect_list(F.struct("line_no", "_text"))).alias("_l"))
    return grouped.select(*KEY, "block", "f.key", "f.heading", "f.page", "f.path", F.transform("_l", lambda x: x["_text"]).alias("lines"))


def keep_longest(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, discarded): of the blocks of one key the longest, the first of equals; an equal copy is discarded too, and logged."""
    size = F.length(F.array_join(F.slice("lines", 2, F.greatest(F.size("lines"), F.lit(2))), " "))
    best = blocks.groupBy(*KEY, "key").agg(F.max(F.struct(size.alias("n"), (-F.col("block")).alias("b"))).alias("m")).select(*KEY, "key", (-F.col("m.b")).alias("_best"))
    joined = blocks.join(best, [*KEY, "key"])
    return joined.where("block = _best").drop("_best"), joined.where("block <> _best").drop("_best")


def vocabulary(lines: DataFrame) -> DataFrame:
    """doc_id, word: every word that a document uses."""
    return lines.select(*KEY, F.explode(F.array_distinct(T.words(F.col("text")))).alias("word")).distinct()


def join_lines(texts: Column, known: Column | None = None) -> Column:
    """Wrapped lines as one text. With the document's words (array `known`) a hyphen at a line end stays if the hyphened
    word is known, and goes otherwise; without them it stays before a space."""

    lines = F.filter(F.transform(texts, T.strip), lambda t: t != "")
    if known is None:
        return F.array_join(lines, " ")
    # The state is what is finished and the last line, which grows only where lines are joined.
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("last"))

    def step(state: Column, text: Column) -> Column:
        last = state["last"]
        prefix, suffix = F.lower(F.regexp_extract(last, r"([A-Za-z]+)-\z", 1)), F.regexp_extract(text, "^([a-z]+)", 1)
        compound = F.array_contains(known, F.concat(prefix, F.lit("-"), suffix))
        grown = F.struct(state["done"].alias("done"), F.concat(F.when(compound, last).otherwise(F.regexp_replace(last, "-\\z", "")), text).alias("last"))
        apart = F.struct(F.when(last == "", state["done"]).otherwise(F.array_append(state["done"], last)).alias("done"), text.alias("last"))
        return F.when(last.endswith("-") & (prefix != "") & (suffix != ""), grown).otherwise(apart)

    walked = F.aggregate(lines, start, step, lambda s: F.array_join(F.array_append(s["done"], s["last"]), " "))
    return F.when(F.exists(lines, lambda t: t.endswith("-")), walked).otherwise(F.array_join(lines, " "))


def needed_words(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """Blocks with `known`: of the words that could settle a line-end hyphen of the block, those the document uses.

    Only candidates are joined, so no document's vocabulary is gathered.
    """
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("lines") - 1, F.lit(1))), lambda i: F.struct(F.regexp_extract(F.get("lines", i - 1), r"([A-Za-z]+)-\s*\z", 1).alias("p"), F.regexp_extract(F.get("lines", i), r"^\s*([a-z]+)", 1).alias("s")))
    wanted = blocks.select(*KEY, "block", F.explode(pairs).alias("x")).where("x.p <> '' AND x.s <> ''").select(*KEY, "block", F.lower(F.concat("x.p", F.lit("-"), "x.s")).alias("word")).distinct()
    met = wanted.join(words, [*KEY, "word"], "left_semi").groupBy(*KEY, "block").agg(F.collect_list("word").alias("known"))
    return blocks.join(met, [*KEY, "block"], "left").withColumn("known", F.coalesce("known", F.array().cast("array<string>")))


def emit_blocks(blocks: DataFrame, chunk_type: str, min_chars: int = 120, label: Column | None = None, path: Column | None = None, words: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejections) of blocks; with `words` hyphens at line ends are settled by the document's vocabulary."""
    source = needed_words(blocks, words) if words is not None else blocks
    joined = source.withColumn("text", join_lines(F.col("lines"), F.col("known") if words is not None else None))
    above = F.col("path") if path is None else path
    full = F.concat_ws(" > ", F.nullif(above, F.lit("")), F.col("key") if label is None else label)
    rows = joined.where(F.length("text") >= min_chars).select("doc_id", F.lit(chunk_type).alias("chunk_type"), F.col("key").alias("slug"), "text", full.alias("section_path"), F.col("block").alias("first_line"), "page")
    return rows, _rejection(joined.where(F.length("text") < min_chars), F.col("key"), "block_too_short", F.concat(F.length("text").cast("string"), F.lit(" chars on page "), F.col("page").cast("string")))


#: An id that another one would get as its k-th repeat: the other id, and k.
_NUMBERED_ID = r"^(.+)-([2-9]|[1-9]\d+)\z"


def with_ids(rows: DataFrame, order: str = "seq") -> DataFrame:
    """Adds id: the natural one for the first row that has it, then the natural one with the least number from 2 on that no
    earlier row has, in the order of emission. `order` is unique.

    Numbers that natural ids already hold are passed over (`intro-2` may be a heading of its own), and a natural id that
    an earlier repeat has taken is itself numbered. Which numbers are passed over follows from counts: a number k of an
    id is reached by a certain repeat, and taken if the row whose natural id it is comes later. So only the ids that
    look like a numbered other one are gone through, not the rows.
    """
    made = rows.withColumn("_id", T.make_id(F.col("doc_id"), F.col("chunk_type"), F.col("slug")))
    made = made.withColumn("_child", F.lit(None).cast("string")).withColumn("_one", F.lit(1))
    ids = stored(made.groupBy("_id").agg(F.count("*").alias("_rows"), F.min(order).alias("_first")), "ids")
    base, number = F.regexp_extract("_id", _NUMBERED_ID, 1), F.regexp_extract("_id", _NUMBERED_ID, 2).try_cast("bigint")
    child = ids.select(F.col("_id").alias("_child"), F.col("_first").alias(order), base.alias("_base"), number.alias("_k")).where("_base <> '' AND _k IS NOT NULL")
    pairs = stored(child.join(ids.select(F.col("_id").alias("_base"), "_rows"), "_base"), "numbered-ids")
    # A row of no weight stands among the rows of the other id, to count how many of them come before.
    events = pairs.select(F.col("_base").alias("_id"), order, "_child", F.lit(0).alias("_one"))
    ranked = ordered.along(made.unionByName(events, allowMissingColumns=True), ["_id"], order, {"_n": F.col("_one")})
    decided = _passed_over(stored(pairs.join(ranked.where("_child IS NOT NULL").select(F.col("_id").alias("_base"), "_child", F.col("_n").alias("_before")), ["_base", "_child"]), "counted-ids"))
    met = ranked.where("_child IS NULL").join(decided, "_id", "left")
    repeat = F.col("_n") - F.when(F.coalesce("_taken", F.lit(False)), 0).otherwise(1)
    none = F.array().cast("array<bigint>")
    numbered = F.aggregate(F.coalesce("_skipped", none), (repeat + 1).cast("bigint"), lambda k, skipped: F.when(skipped <= k, k + 1).otherwise(k))
    return met.withColumn("id", F.when(repeat == 0, F.col("_id")).otherwise(F.concat("_id", F.lit("-"), numbered.cast("string")))).select(*rows.columns, "id")


def _passed_over(pairs: DataFrame) -> DataFrame:
    """_id, _taken (whether its natural form was taken by a repeat of another id), _skipped (numbers its repeats pass over).

    Ids whose own natural form may be taken wait for the other id; a chain is as long as there are numbers at the end
    of an id (`intro-2-3`).
    """
    spark = pairs.sparkSession
    decided = spark.createDataFrame([], "_id string, _taken boolean, _skipped array<bigint>")
    while not pairs.isEmpty():
        ready = pairs.join(pairs.select(F.col("_child").alias("_base")).distinct(), "_base", "left_anti")
        known = decided.groupBy(F.col("_id").alias("_base")).agg(F.max("_taken").alias("_taken"))
        held = ready.join(known, "_base", "left").withColumn("_own", F.when(F.coalesce("_taken", F.lit(False)), 0).otherwise(1))
        about = held.groupBy("_base").agg(F.max(F.col("_rows") - F.col("_own")).alias("_repeats"), F.array_sort(F.collect_list(F.struct("_k", (F.col("_before") - F.least(F.col("_before"), F.col("_own"))).alias("_past"), "_child"))).alias("_l"))
        start = F.struct(F.array().cast("array<bigint>").alias("skipped"), F.array().cast("array<string>").alias("taken"))

        def step(state: Column, x: Column) -> Column:
            reached = x["_k"] - 1 - F.size(state["skipped"])
            passed = F.struct(F.array_append(state["skipped"], x["_k"]).alias("skipped"), state["taken"].alias("taken"))
            held_ = F.struct(state["skipped"].alias("skipped"), F.array_append(state["taken"], x["_child"]).alias("taken"))
            return F.when(reached > F.col("_repeats"), state).when(reached > x["_past"], passed).otherwise(held_)

        result = stored(about.withColumn("_s", F.aggregate("_l", start, step)).select("_base", "_s.skipped", "_s.taken"), "decided-ids")
        found = result.select(F.col("_base").alias("_id"), F.lit(False).alias("_taken"), F.col("skipped").alias("_skipped")).unionByName(
            result.select(F.explode("taken").alias("_id"), F.lit(True).alias("_taken"), F.lit(None).cast("array<bigint>").alias("_skipped"))
        )
        decided = decided.unionByName(found)
        pairs = stored(pairs.join(ready.select("_base").distinct(), "_base", "left_anti"), "counted-ids")
    return decided.groupBy("_id").agg(F.max("_taken").alias("_taken"), F.max("_skipped").alias("_skipped"))


def appendix_spans(lines: DataFrame, title: str, larger_by: float = 3.0) -> DataFrame:
    """doc_id, first, last: the pages from a title in display type to the page before the next line set as large."""
    big = lines.join(body_font_size(lines), KEY).where(F.col("size") >= F.col("body_size") + larger_by)
    start = big.where(F.upper(T.strip(F.col("text"))) == title.upper()).groupBy(*KEY).agg(F.min_by("page", "line_no").alias("first"), F.min("line_no").alias("_at"))
    following = big.join(start, KEY).where((F.col("line_no") > F.col("_at")) & (F.col("page") > F.col("first"))).groupBy(*KEY).agg(F.min_by("page", "line_no").alias("_next"))
    return start.join(following, KEY, "left").join(page_counts(lines), KEY).select(*KEY, "first", F.coalesce(F.col("_next") - 1, F.col("pages")).alias("last"))


def pages_containing(lines: DataFrame, pattern: str) -> DataFrame:
    return lines.where(F.col("text").rlike(pattern)).select(*KEY, "page").distinct().orderBy(*KEY, "page")


def excluded_from(lines: DataFrame, pattern: str) -> DataFrame:
    """doc_id, page: where the body first has a line of the pattern, contents entries aside."""
    body = lines.join(contents_pages(lines), [*KEY, "page"], "left_anti").where(~F.col("text").rlike(LEADERS))
    return body.where(T.strip(F.col("text")).rlike(pattern)).groupBy(*KEY).agg(F.min_by("page", "line_no").alias("page"))


def term_definitions(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, term, text, first_line of a glossary whose terms are told by type: bold, or a smaller source line below.

    A term may wrap; up to two short lines before a term that ends no sentence belong to it. Lines set larger than the
    body are left out, and so is what comes before the first term.
    """
    content = without_furniture(lines).join(body_font_size(lines), KEY).join(spans, KEY).where(F.col("page").between(F.col("first"), F.col("last")))
    content = content.where(~T.strip(F.col("text")).rlike(HEADER_ONLY)).select(*KEY, "line_no", T.strip(F.col("text")).alias("text"), "size", F.coalesce("bold", F.lit(False)).alias("bold"), "body_size")
    source = (F.col("size") < F.col("body_size") - 0.3) & F.col("text").rlike(SOURCE_LINE)
    below = ordered.along(content, KEY, "line_no", carry={"_below": F.coalesce(source, F.lit(False))}, forward=False, current=False)
    told = (F.col("text") != "") & (F.length("text") <= 80) & (F.abs(F.col("size") - F.col("body_size")) < 0.5)
    kind = F.when(told & (F.col("bold") | F.coalesce("_below", F.lit(False))), "term").when(F.col("size") <= F.col("body_size"), "body")
    kinds = ordered.along(below.withColumn("_kind", kind).where("_kind IS NOT NULL"), KEY, "line_no", carry={"_last": F.col("_kind")}, current=False)
    begins = (F.col("_kind") == "term") & ~F.coalesce(F.col("_last") == "term", F.lit(False))
    entries = ordered.along(kinds, KEY, "line_no", {"entry": begins.cast("int")}).where("entry > 0")
    listed = lambda which: F.array_sort(F.collect_list(F.when(F.col("_kind") == which, F.struct("line_no", "text"))))
    # An entry of a printed glossary is gathered in one row.
    grouped = entries.groupBy(*KEY, "entry").agg(F.min("line_no").alias("first_line"), F.transform(listed("term"), lambda x: x["text"]).alias("_term"), F.transform(listed("body"), lambda x: x["text"]).alias("_body"))
    loose = lambda i: F.coalesce((F.length(F.get("_body", F.size("_body") - i)) <= 60) & ~F.get("_body", F.size("_body") - i).rlike(r"[.;:]\z"), F.lit(False))
    several = ordered.along(grouped, KEY, "first_line", carry={"_next": F.col("entry")}, forward=False, current=False)
    tail = F.when(F.col("_next").isNull(), 0).when(loose(1) & loose(2), 2).when(loose(1), 1).otherwise(0)
    cut = several.withColumn("_tail", F.slice("_body", F.greatest(F.size("_body") - tail + 1, F.lit(1)), tail)).withColumn("_body", F.slice("_body", 1, F.size("_body") - tail))
    met = ordered.along(cut, KEY, "first_line", carry={"_pulled": F.col("_tail")}, current=False)
    term = F.array_join(F.concat(F.coalesce("_pulled", F.array().cast("array<string>")), "_term"), " ")
    body = F.trim(F.array_join("_body", " "))
    return met.select(*KEY, term.alias("term"), F.when(body != "", F.concat(term, F.lit(": "), body)).otherwise(term).alias("text"), "first_line")


OBJECTIVES, LEVELS = ("Confidentiality", "Integrity", "Availability"), ("LOW", "MODERATE", "HIGH")


def trim_grid(grid: Column) -> Column:
    """A table's cells stripped, columns that are blank throughout left out, short rows padded."""
    cells = F.transform(grid, lambda row: F.transform(row, lambda c: T.strip(F.coalesce(c, F.lit("")))))
    width = F.size(F.get(grid, 0))
    used = F.filter(F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0))), lambda i: F.exists(cells, lambda row: F.coalesce(F.get(row, i), F.lit("")) != ""))
    return F.transform(cells, lambda row: F.transform(used, lambda i: F.coalesce(F.get(row, i), F.lit(""))))


def transcribe_impact_table(grid: Column) -> Column:
    """A matrix of objectives and levels as lines `objective / level: cell`, with definitions; null without all three objectives."""
    squeezed = lambda c: clean_heading(c)

    def row_lines(row: Column) -> Column:
        first = squeezed(F.get(row, 0))
        objective = F.lit(None).cast("string")
        for name in reversed(OBJECTIVES):
            objective = F.when(F.upper(first).startswith(name.upper()), name).otherwise(objective)
        definition = F.regexp_replace(F.substr(first, F.length(objective) + 1), r"^[ .:\-]+|[ .:\-]+\z", "")
        cells = F.filter(F.transform(F.slice(row, 2, F.greatest(F.size(row), F.lit(2))), squeezed), lambda c: c != "")
        levels = F.array(*[F.lit(x) for x in LEVELS])
        labelled = F.transform(F.arrays_zip(F.slice(levels, 1, F.least(F.size(cells), F.lit(3))).alias("l"), F.slice(cells, 1, 3).alias("c")), lambda z: F.concat(objective, F.lit(" / "), z["l"], F.lit(": "), z["c"]))
        defined = F.when(definition != "", F.array(F.concat(objective, F.lit(" (definition): "), definition))).otherwise(F.array().cast("array<string>"))
        return F.when(objective.isNull() | (F.size(row) == 0), F.array().cast("array<string>")).otherwise(F.concat(defined, labelled))

    lines = F.flatten(F.transform(grid, row_lines))
    seen = F.size(F.array_distinct(F.filter(F.transform(lines, lambda x: F.substring_index(x, " / ", 1)), lambda o: o.isin(*OBJECTIVES))))
    return F.when(seen >= 3, F.array_join(lines, "\n"))
