"""The ordered chain of validation rules: a row is rejected by the first one it fails, and never silently.

Rules that look at one row are one expression; then come duplicates, which depend on the order of rows; then encoding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern import schemas
from quern.functions import text as T
from quern.operators import dedupe
from quern.session import stored

ENCODING = "encoding_clean"
ORDER = (
    "schema_valid", "doc_in_manifest", "control_family_whitelist", "control_id_source", "running_header_fragment", "length_bounds", "no_template_residue", "no_furniture",
    "bibliography_entry", "midsentence_fragment", "unique_id", "near_dupe", ENCODING,
)


def _quoted(value: Column) -> Column:
    return F.concat(F.lit("'"), F.coalesce(value.cast("string"), F.lit("null")), F.lit("'"))


def row_rules() -> list[tuple[str, Column, Column]]:
    """(rule, whether it fails, detail) in order, for rows with `_format` and `_hash_known` joined on."""
    text, kind = F.col("text"), F.col("chunk_type")
    floor = T.min_text_len(kind)
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in schemas.REQUIRED]))
    marks = F.filter(F.array(*[F.lit(m) for m in T.TEMPLATE_MARKS]), lambda m: F.contains(text, m))
    remnant = text.rlike(T.RUNNING_HEADER) | F.coalesce(F.col("section_path"), F.lit("")).rlike(T.SINGLE_CHARACTER_SEGMENT)
    furniture = text.rlike(T.FURNITURE[0]) | text.rlike(T.FURNITURE[1]) | text.rlike(T.FURNITURE[2])
    has_control = F.col("control_id").isNotNull()
    return [
        ("schema_valid", F.size(missing) > 0, F.concat(F.lit("missing values: "), F.array_join(missing, ", "))),
        ("schema_valid", ~kind.isin(*schemas.CHUNK_TYPES), F.concat(F.lit("chunk_type "), _quoted(kind), F.lit(" not in enum"))),
        ("schema_valid", ~F.col("tier").isin(1, 2), F.concat(F.lit("tier "), F.col("tier").cast("string"), F.lit(" is not 1 or 2"))),
        ("doc_in_manifest", F.col("_format").isNull(), F.concat(F.lit("doc_id "), _quoted(F.col("doc_id")), F.lit(" is not in the manifest"))),
        ("doc_in_manifest", ~F.col("_hash_known"), F.concat(F.lit("sha256_source "), F.substring("sha256_source", 1, 12), F.lit("… matches no retrieved artifact"))),
        ("control_family_whitelist", has_control & ~T.is_control_id(F.col("control_id")), F.concat(F.lit("control_id "), _quoted(F.col("control_id")), F.lit(" is of no known family"))),
        ("control_id_source", has_control & ~F.col("_format").isin(*schemas.CONTROL_FORMATS), F.concat(F.lit("control_id present but the format is "), _quoted(F.col("_format")))),
        ("running_header_fragment", remnant & (F.length(T.strip_running_header(text)) < floor), F.lit("no substantive body under the running-header remnant")),
        ("length_bounds", ~F.length(text).between(floor, schemas.MAX_TEXT), F.concat(F.length(text).cast("string"), F.lit(" chars outside ["), floor.cast("string"), F.lit(f", {schemas.MAX_TEXT}] for "), kind)),
        ("no_template_residue", F.size(marks) > 0, F.concat(F.lit("text contains "), F.array_join(marks, ", "))),
        ("no_furniture", furniture, F.lit("text matches a header, footer or page-number pattern")),
        ("bibliography_entry", T.is_reference_entry(text), F.lit("text is a reference-list entry")),
        ("midsentence_fragment", (kind == "section") & (text.rlike(T.MID_SENTENCE[0]) | text.rlike(T.MID_SENTENCE[1])), F.concat(F.lit("section text begins mid-sentence: "), _quoted(F.substring(text, 1, 60)))),
    ]


def encoding_fails(text: Column) -> Column:
    return text.contains("�") | T.has_control_characters(text) | ~F.is_valid_utf8(text)


def with_dimensions(rows: DataFrame, manifest: DataFrame, provenance: DataFrame) -> DataFrame:
    """Adds `_format` (null where the manifest has no such document) and `_hash_known`.

    No hint is given: the planner broadcasts these tables while they are small, and knows by how much.
    """
    formats = manifest.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.coalesce("format", F.lit(""))).alias("_format"))
    hashes = provenance.where("sha256 IS NOT NULL").select(F.col("sha256").alias("sha256_source")).distinct().withColumn("_hash", F.lit(True))
    joined = rows.join(formats, "doc_id", "left").join(hashes, "sha256_source", "left")
    return joined.select(*rows.columns, "_format", F.coalesce("_hash", F.lit(False)).alias("_hash_known"))


def tagged(rows: DataFrame, manifest: DataFrame, provenance: DataFrame) -> DataFrame:
    """Rows with `failed`: struct of rule and detail of the first row rule that fails, null if none does."""
    first = F.coalesce(*[F.when(F.coalesce(fails, F.lit(False)), F.struct(F.lit(rule).alias("rule"), detail.alias("detail"))) for rule, fails, detail in row_rules()])
    return with_dimensions(rows, manifest, provenance).withColumn("failed", first).drop("_format", "_hash_known")


def validate(rows: DataFrame, manifest: DataFrame, provenance: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejections) of rows with a unique `seq`; every row is in exactly one of them.

    Of rows that share an id or a fingerprint with an accepted earlier row, the later ones go. Rows with bad encoding
    are compared with earlier ones, but no later row is compared with them.
    """
    text = F.col("text")
    judged = tagged(rows, manifest, provenance).select(
        "seq", "id", "doc_id", "failed", F.when(F.col("failed").isNull(), F.sha2(T.fingerprint(text), 256)).alias("print"), F.when(F.col("failed").isNull(), ~encoding_fails(text)).alias("registers")
    )
    # Written once, without the texts; they are only read again for the rows that stay.
    judged = stored(judged, "judged")
    passed = judged.where("failed IS NULL")
    decided = passed.join(dedupe.greedy(passed, "seq", "id", "print", "registers"), "seq")
    rule = F.when(F.col("verdict") == "left", "unique_id").when(F.col("verdict") == "right", "near_dupe").when(F.col("verdict") == "unregistered", ENCODING)
    detail = F.when(F.col("verdict") == "left", "duplicate row id").when(F.col("verdict") == "right", F.concat(F.lit("text identical to row "), F.col("of").cast("string"))).otherwise("replacement or control characters in text")
    late = decided.where(rule.isNotNull()).select("doc_id", F.col("id").alias("ref"), rule.alias("rule"), detail.alias("detail"), F.lit("validate").alias("stage"))
    early = judged.where("failed IS NOT NULL").select("doc_id", F.col("id").alias("ref"), "failed.rule", "failed.detail", F.lit("validate").alias("stage"))
    valid = rows.join(decided.where("verdict = 'accepted'").select("seq"), "seq", "left_semi").select(*rows.columns)
    return valid, early.unionByName(late)
