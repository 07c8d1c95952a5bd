"""Right-sizing of chunks: normalising, stripping leading furniture, folding stubs forward, splitting what is too long.

Rows carry `seq`, their place in the build: the order decides which section a stub belongs to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern import schemas
from quern.functions import text as T
from quern.operators import ordered
from quern.session import stored

#: A part shorter than this is folded into its neighbour.
LEAST_PART = schemas.TARGET_PART // 8


def hard_split(paragraph: Column, limit: int) -> Column:
    """A paragraph cut between sentences, packed up to `limit`; a longer sentence is cut at the last space before it.

    Sentences end at `.`, `;` or `:` before white space. A run without spaces is cut at the limit, and what precedes a
    long sentence stays in front of it.
    """
    long_sentence = f"(?s)(.{{1,{limit}}}\\z|.{{1,{max(1, limit - 1)}}}(?= )|.{{{limit}}})\\s*"

    def units(sentence: Column) -> Column:
        cut = F.transform(F.regexp_extract_all(sentence, F.lit(long_sentence), 1), T.strip)
        several = F.transform(cut, lambda piece, i: F.struct(piece.alias("text"), (i < F.size(cut) - 1).alias("alone")))
        return F.when(F.length(sentence) > limit, several).otherwise(F.array(F.struct(sentence.alias("text"), F.lit(False).alias("alone"))))

    sentences = F.flatten(F.transform(F.split(paragraph, r"(?<=[.;:])\s+"), units))
    start = F.struct(F.array().cast("array<string>").alias("pieces"), F.lit("").alias("current"))

    def pack(state: Column, unit: Column) -> Column:
        flushed = F.when(state["current"] == "", state["pieces"]).otherwise(F.array_append(state["pieces"], state["current"]))
        fits = F.length(state["current"]) + 1 + F.length(unit["text"]) <= limit
        return (
            F.when(unit["alone"], F.struct(F.array_append(flushed, unit["text"]).alias("pieces"), F.lit("").alias("current")))
            .when(state["current"] == "", F.struct(state["pieces"].alias("pieces"), unit["text"].alias("current")))
            .when(fits, F.struct(state["pieces"].alias("pieces"), F.concat(state["current"], F.lit(" "), unit["text"]).alias("current")))
            .otherwise(F.struct(flushed.alias("pieces"), unit["text"].alias("current")))
        )

    def finish(state: Column) -> Column:
        return F.when(state["current"] == "", state["pieces"]).otherwise(F.array_append(state["pieces"], state["current"]))

    return F.aggregate(sentences, start, pack, finish)


def _packed(blocks: Column, target: int, most: int) -> Column:
    """Blocks joined by blank lines into parts of at most `target`, each starting with the last block of the part before
    unless that is long (half the target) or would push the part over the hard limit `most`."""
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.array().cast("array<string>").alias("current"), F.lit(0).alias("length"))

    def add(state: Column, block: Column) -> Column:
        n, size = F.size(state["current"]), F.length(block)
        overflow = (n > 0) & (state["length"] + size + 2 > target)
        tail = F.element_at(state["current"], -1)
        overlap = (F.length(tail) < target // 2) & (F.length(tail) + 2 + size <= most)
        after = F.struct(
            F.array_append(state["parts"], F.array_join(state["current"], "\n\n")).alias("parts"),
            F.when(overlap, F.array(tail, block)).otherwise(F.array(block)).alias("current"),
            F.when(overlap, F.length(tail) + 2 + size).otherwise(size).alias("length"),
        )
        within = F.struct(state["parts"].alias("parts"), F.array_append(state["current"], block).alias("current"), (state["length"] + size + F.when(n > 0, 2).otherwise(0)).alias("length"))
        return F.when(overflow, after).otherwise(within)

    return F.aggregate(blocks, start, add, lambda s: F.when(F.size(s["current"]) > 0, F.array_append(s["parts"], F.array_join(s["current"], "\n\n"))).otherwise(s["parts"]))


def balance(parts: Column, least: int = LEAST_PART) -> Column:
    """Short parts folded into the one before; a short first part into the one after."""

    def fold(done: Column, part: Column) -> Column:
        n = F.size(done)
        merged = F.array_append(F.slice(done, 1, n - 1), F.concat(F.element_at(done, n), F.lit("\n\n"), part))
        return F.when((n > 0) & (F.length(part) < least), merged).otherwise(F.array_append(done, part))

    folded = F.aggregate(parts, F.array().cast("array<string>"), fold)
    first = F.concat(F.array(F.concat(folded[0], F.lit("\n\n"), folded[1])), F.slice(folded, 3, F.greatest(F.size(folded), F.lit(3))))
    return F.when((F.size(folded) > 1) & (F.length(folded[0]) < least), first).otherwise(folded)


def split_text(text: Column, target: int = schemas.TARGET_PART, most: int = schemas.MAX_TEXT) -> Column:
    """The parts of a text, cut between paragraphs where possible, with one paragraph of overlap; parts under an eighth of
    the target are folded into a neighbour."""
    blocks = F.flatten(F.transform(T.paragraphs(text), lambda p: F.when(F.length(p) > target, hard_split(p, target)).otherwise(F.array(p))))
    return balance(_packed(blocks, target, most), target // 8)


def split_rows(rows: DataFrame, max_len: int = schemas.MAX_TEXT, target: int = schemas.TARGET_PART) -> DataFrame:
    """Rows over `max_len` as parts, numbered from 1 in id and section_path; adds part (0 for whole rows)."""
    # Short rows never meet the packing expressions, which are not compiled.
    small = rows.where(F.coalesce(F.length("text") <= max_len, F.lit(True))).withColumn("part", F.lit(0))
    parts = rows.where(F.length("text") > max_len).withColumn("_parts", split_text(F.col("text"), target, max_len))
    big = parts.select(*[c for c in parts.columns if c != "_parts"], F.posexplode("_parts").alias("_n", "_piece"), F.size("_parts").alias("_of"))
    several = F.col("_of") > 1
    label = F.concat(F.lit(" (part "), (F.col("_n") + 1).cast("string"), F.lit(")"))
    changed = {"id": F.concat("id", label), "text": F.col("_piece"), "section_path": F.concat(F.nullif(F.col("section_path"), F.lit("")), label)}
    big = big.select(*[F.when(several, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in rows.columns], F.when(several, F.col("_n") + 1).otherwise(0).alias("part"))
    return small.unionByName(big)


def strip_leading_furniture(rows: DataFrame) -> DataFrame:
    """Leading running-header remnants and citation tags removed where enough text remains under them."""
    # Every step is a column of its own, so that no expression is computed or compiled twice.
    step = rows.withColumn("_floor", T.min_text_len(F.col("chunk_type"))).withColumn("_cleaned", T.strip_running_header(F.col("text")))
    step = step.withColumn("_text", F.when(F.length("_cleaned") >= F.col("_floor"), F.col("_cleaned")).otherwise(F.col("text")))
    step = step.withColumn("_tagged", F.col("_text").rlike(T.REFERENCE_TAG) & ~T.is_reference_entry(F.col("_text"))).withColumn("_untagged", T.strip_reference_tag(F.col("_text")))
    step = step.withColumn("_text", F.when(F.col("_tagged") & (F.length("_untagged") >= F.col("_floor")), F.col("_untagged")).otherwise(F.col("_text")))
    step = step.withColumn("_path", T.strip(F.regexp_replace(T.strip_running_header(F.col("section_path")), "^[> ]+", "")))
    path = F.when((F.col("_text") != F.col("text")) & (F.col("_path") != ""), F.col("_path")).otherwise(F.col("section_path"))
    changed = {"text": F.col("_text"), "section_path": path}
    return step.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in rows.columns])


def merge_short_sections(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejections): runs of short sections folded into the next other row of their document if it is a section.

    Otherwise each of the run is rejected as trailing_furniture. The receiver keeps its id and path. Only what decides
    is moved to find the receivers; texts meet in the group of one receiver.
    """
    short = (F.col("chunk_type") == "section") & (F.length("text") < T.min_text_len(F.col("chunk_type")))
    marked = rows.withColumn("_short", F.coalesce(short, F.lit(False)))
    slim = marked.select("doc_id", "seq", "_short", "chunk_type")
    following = F.when(~F.col("_short"), F.struct(F.col("seq").alias("at"), F.col("chunk_type").eqNullSafe(F.lit("section")).alias("fits")))
    stubs = ordered.carried(slim, {"_next": following}, ["doc_id"], "seq", forward=False).where("_short").select(F.col("doc_id").alias("_doc"), F.col("seq").alias("_seq"), "_next")
    placed = marked.where("_short").join(stubs, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("seq") == F.col("_seq")))
    kept = placed.where("_next.fits").groupBy("doc_id", F.col("_next.at").alias("at")).agg(F.sort_array(F.collect_list(F.struct("seq", "text"))).alias("_stubs"))
    kept = kept.select(F.col("doc_id").alias("_doc"), "at", F.transform("_stubs", lambda s: s["text"]).alias("_stubs"))
    whole = marked.where(~F.col("_short")).join(kept, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("seq") == F.col("at")), "left")
    merged_text = F.when(F.col("_stubs").isNull(), F.col("text")).otherwise(T.normalize_text(F.array_join(F.array_append("_stubs", F.col("text")), "\n\n")))
    merged = whole.withColumn("text", merged_text).select(*rows.columns)
    lost = placed.where(~F.coalesce(F.col("_next.fits"), F.lit(False)))
    rejected = lost.select("doc_id", F.col("id").alias("ref"), F.lit("trailing_furniture").alias("rule"), F.concat(F.length("text").cast("string"), F.lit(" chars, no following section to merge into")).alias("detail"), F.lit("chunk").alias("stage"))
    return merged, rejected


def chunk_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The whole stage on rows with `seq`: (right-sized rows with seq and part, rejections)."""
    # Written once: five branches read it.
    normal = stored(strip_leading_furniture(rows.withColumn("text", T.normalize_text(F.col("text")))), "normal")
    merged, rejected = merge_short_sections(normal)
    return split_rows(merged), rejected
