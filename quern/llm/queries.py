"""The queries of the llm operators, over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm import leaks, mixing, pieces, reading, refine, residue, scans


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.faults(_table(spark, sf_dir, "chunks"))


def p1_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text that has faults, as continuous paragraphs."""
    return scans.repaired(_table(spark, sf_dir, "chunks")).where("faults > 0")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = refine.copies(_table(spark, sf_dir, "interim_records"))
    return found.where("rec_id <> kept_rec_id").select("kept_rec_id", "rec_id")


def p2_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each class of copies, with the number of its copies."""
    return refine.collapsed(_table(spark, sf_dir, "interim_records"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.pieces(_table(spark, sf_dir, "chunks"), _table(spark, sf_dir, "split_limits"))
    return found.where("piece = 1").select("row_no", "boundary")


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every oversized chunk."""
    return pieces.pieces(_table(spark, sf_dir, "chunks"), _table(spark, sf_dir, "split_limits"))


def p3_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the pieces of every oversized chunk: put together without the overlaps they give its text back
    (by its hash), none is empty or over the limit, neighbours share exactly the overlap, and their paths differ."""
    limits = _table(spark, sf_dir, "split_limits")
    chunks = _table(spark, sf_dir, "chunks")
    cut = pieces.pieces(chunks, limits).join(pieces.oversized(chunks, limits).select("row_no", "max_chars", "overlap"), "row_no")
    tail = F.when(F.col("piece") == 1, F.col("text")).otherwise(F.substr("text", F.col("overlap") + 1))
    one = F.struct("piece", tail.alias("tail"), F.substr("text", F.lit(1), F.col("overlap")).alias("head"), F.right("text", F.col("overlap")).alias("end"))
    whole = cut.groupBy("row_no").agg(F.array_sort(F.collect_list(one)).alias("l"), F.min((F.length("text") <= F.col("max_chars")) & (F.length("text") > 0)).alias("within"), F.countDistinct("section_path").alias("paths"))
    shared = F.forall(F.sequence(F.lit(1), F.size("l") - 1), lambda i: F.get("l", i)["head"] == F.get("l", i - 1)["end"])
    return whole.select("row_no", F.md5(F.array_join(F.transform("l", lambda x: x["tail"]), "")).alias("md5"), "within", shared.alias("shared"), (F.col("paths") == F.size("l")).alias("told_apart"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue(_table(spark, sf_dir, "chunks")).select("row_no")


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that hold no residue."""
    return residue.without_residue(_table(spark, sf_dir, "chunks")).select("row_no", "id", "text", "doc_id", "chunk_type", "section_path")


def p4_parted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that are free of residue and those that are not: together every chunk once."""
    return p4_found(spark, sf_dir).withColumn("clean", F.lit(False)).unionByName(p4_clean(spark, sf_dir).select("row_no", F.lit(True).alias("clean"))).select("row_no")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items"))
    return found.select("doc_id", "item_id").distinct()


def p6_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with leaked passages cut out, or dropped where they cover too much of it."""
    return leaks.without_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items"))


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slot of the mixture with the tokens of the documents that fill it."""
    return mixing.mixture(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted and actual shares by source."""
    return mixing.shares(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))


def p7_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the mixture for every source with a target: met (its share of all tokens but for rounding), kept
    (no more tokens than max_repeats allows), counted (the slots hold what the report says), once (each block fills a
    slot at most once in each repeat), whole (the tokens of a slot are those of its parts)."""
    mixed = p7_mixture(spark, sf_dir)
    parts = F.aggregate("parts", F.lit(0), lambda n, p: n + p["to_token"] - p["from_token"])
    by_source = mixed.groupBy("source").agg(
        F.sum("tokens").alias("in_slots"), (F.countDistinct("repeat", "block") == F.count("*")).alias("once"), F.min((parts == F.size("ids")) & (F.col("tokens") == F.size("ids"))).alias("whole")
    )
    report = p7_shares(spark, sf_dir).join(by_source, "source", "left")
    # One row for each source, a few dozen.
    total, sources = F.sum("mixture_tokens").over(Window.partitionBy(F.lit(1))), F.count("*").over(Window.partitionBy(F.lit(1)))
    return report.select(
        "source", F.round("target_share", 9).alias("target_share"), "max_repeats", "documents", (F.abs(F.col("mixture_tokens") - total * F.col("reachable_share")) <= sources + 1).alias("met"), (F.col("mixture_tokens") <= F.col("available_tokens") * F.col("max_repeats")).alias("kept"),
        (F.coalesce("in_slots", F.lit(0)) == F.col("mixture_tokens")).alias("counted"), F.coalesce("once", F.lit(True)).alias("once"), F.coalesce("whole", F.lit(True)).alias("whole"),
    )


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = reading.reading_levels(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "reading_labels"))
    return levels.select("doc_id", "band").distinct()


def p8_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents of each source, plainly spelled, have each band."""
    documents = _table(spark, sf_dir, "documents")
    levels = reading.reading_levels(documents, _table(spark, sf_dir, "reading_labels"))
    named = documents.select("doc_id", F.coalesce(mixing.plain_source(F.col("source")), F.lit("")).alias("source"))
    return levels.join(named, "doc_id").groupBy("source", "band").agg(F.count("*").alias("documents"), F.round(F.avg("level"), 3).alias("mean_level"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_repaired, p2_found, p2_collapsed, p3_found, p3_pieces, p3_checked, p4_found, p4_clean, p4_parted, p6_found, p6_clean, p7_mixture, p7_shares, p7_checked, p8_found, p8_profile)}


#: Twelve consecutive words of a document, normalised as the operator does, against those of every item.
_P6 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
     e AS (SELECT item_id, regexp_extract_all(lower(item_text), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE item_text IS NOT NULL),
     dg AS (SELECT doc_id, array_to_string(w[i : i + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS i FROM d WHERE len(w) >= 12)),
     eg AS (SELECT item_id, array_to_string(w[i : i + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS i FROM e WHERE len(w) >= 12))
SELECT DISTINCT dg.doc_id, eg.item_id FROM dg JOIN eg USING (g)
"""

#: The words of every document that lie in a shared run of twelve, and what is left without them and what stands between them.
_P6_CLEAN = r"""
WITH e AS (SELECT regexp_extract_all(lower(item_text), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE item_text IS NOT NULL),
     g AS (SELECT DISTINCT array_to_string(w[i : i + 11], ' ') AS g FROM (SELECT w, unnest(range(1, len(w) - 10)) AS i FROM e WHERE len(w) >= 12)),
     d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
     h AS (SELECT doc_id, i, array_to_string(w[i : i + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS i FROM d WHERE len(w) >= 12)),
     c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 12)) AS k FROM h SEMI JOIN g USING (g)),
     n AS (SELECT doc_id, count(*)::INT AS removed FROM c GROUP BY doc_id),
     p AS (SELECT doc_id, j, x[j] AS x, regexp_matches(x[j], '^[\p{L}\p{N}]') AS word FROM (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}]+') AS x FROM documents SEMI JOIN n USING (doc_id)), unnest(range(1, len(x) + 1)) AS u(j)),
     q AS (SELECT *, sum(word::INT) OVER (PARTITION BY doc_id ORDER BY j) AS k FROM p),
     r AS (SELECT q.doc_id, string_agg(x, '' ORDER BY j) FILTER (NOT coalesce(a.k IS NOT NULL AND (word OR b.k IS NOT NULL), false)) AS text FROM q LEFT JOIN c AS a ON a.doc_id = q.doc_id AND a.k = q.k LEFT JOIN c AS b ON b.doc_id = q.doc_id AND b.k = q.k + 1 GROUP BY q.doc_id)
SELECT t.doc_id, CASE WHEN n.removed IS NULL THEN t.text WHEN n.removed / len(d.w) > 0.3 THEN NULL ELSE coalesce(r.text, '') END AS text, coalesce(n.removed, 0)::INT AS removed_words, coalesce(len(d.w), 0)::INT AS total_words,
  coalesce(n.removed / len(d.w), 0.0)::DOUBLE AS coverage, CASE WHEN n.removed IS NULL THEN 'clean' WHEN n.removed / len(d.w) > 0.3 THEN 'dropped' ELSE 'cut' END AS verdict
FROM documents t LEFT JOIN d USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id)
"""


_FIELDS = ("id", "text", "doc_id", "doc_title", "revision", "pub_date", "tier", "chunk_type", "control_id", "section_path", "source_url", "sha256_source")
_P2_CLASSES = (
    "WITH k AS (SELECT rec_id, concat_ws('|', "
    + ", ".join(rf"regexp_replace(lower(coalesce(json_extract_string(payload, '$.{f}'), '')), '[^\p{{L}}\p{{N}}]', '', 'g')" for f in _FIELDS)
    + r""") AS key FROM interim_records WHERE json_valid(payload)),
     m AS (SELECT rec_id, min(rec_id) OVER (PARTITION BY key) AS kept_rec_id, count(*) OVER (PARTITION BY key) AS copies FROM k)
"""
)
_P2 = _P2_CLASSES + "SELECT kept_rec_id, rec_id FROM m WHERE rec_id <> kept_rec_id"
_P2_COLLAPSED = _P2_CLASSES + "SELECT r.rec_id, r.payload, coalesce(m.copies, 1) AS copies FROM interim_records r LEFT JOIN m USING (rec_id) WHERE m.rec_id IS NULL OR m.kept_rec_id = m.rec_id"

_P3 = r"""
WITH big AS (SELECT row_no, text, max_chars FROM chunks JOIN split_limits USING (chunk_type) WHERE length(text) > max_chars),
     para AS (SELECT row_no, max_chars, unnest(regexp_split_to_array(text, '\n(?:[ \t]*\n)+')) AS p FROM big),
     para2 AS (SELECT row_no, max_chars, regexp_replace(p, '^\s+|\s+$', '', 'g') AS p FROM para),
     sent AS (SELECT row_no, max_chars, length(p) AS n, unnest(string_split(regexp_replace(p, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) AS s FROM para2)
SELECT row_no, CASE WHEN max(n) <= any_value(max_chars) THEN 'paragraph' WHEN max(length(s)) <= any_value(max_chars) THEN 'sentence' ELSE 'none' END AS boundary
FROM sent GROUP BY row_no
"""

_P3_CHECKED = "SELECT row_no, md5(text) AS md5, true AS within, true AS shared, true AS told_apart FROM chunks JOIN split_limits USING (chunk_type) WHERE length(text) > max_chars"

_P7_CHECKED = r"""WITH d AS (SELECT regexp_replace(regexp_replace(lower(source), '^[\s_-]+|[\s_-]+$', '', 'g'), '[\s_-]+', '_', 'g') AS source, count(*) AS documents FROM documents WHERE text <> '' AND source IS NOT NULL GROUP BY 1)
SELECT source, round(target_share, 9) AS target_share, max_repeats, coalesce(documents, 0) AS documents, true AS met, true AS kept, true AS counted, true AS once, true AS whole FROM mix_targets LEFT JOIN d USING (source)"""


def oracle_sql() -> dict[str, str]:
    return {"p2_found": _P2, "p2_collapsed": _P2_COLLAPSED, "p3_found": _P3, "p3_checked": _P3_CHECKED, "p6_found": _P6, "p6_clean": _P6_CLEAN, "p4_parted": "SELECT row_no FROM chunks", "p7_checked": _P7_CHECKED}
