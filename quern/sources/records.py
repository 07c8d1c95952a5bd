"""Rows and rejections in files between stages, and the playbook of guidance records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import schemas
from quern.functions import text as T
from quern.operators import ordered


def decoded(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Adds `row` (struct of the row's fields) and `problem` (null if the payload is exactly a row).

    A payload that is cut off or no object, that lacks a field or has one too many is a problem: the reader of a build
    must stop rather than publish half a row.
    """
    keys = F.json_object_keys(column)
    names = F.array(*[F.lit(f) for f in schemas.ROW_FIELDS])
    missing, extra = F.array_sort(F.array_except(names, keys)), F.array_sort(F.array_except(keys, names))
    whole = F.try_parse_json(column).isNotNull()
    problem = (
        F.when(F.col(column).isNull() | ~whole | keys.isNull(), "not a complete JSON object")
        .when(F.size(missing) > 0, F.concat(F.lit("row missing fields: "), F.array_join(missing, ", ")))
        .when(F.size(extra) > 0, F.concat(F.lit("row has unknown fields: "), F.array_join(extra, ", ")))
    )
    return payloads.withColumn("problem", problem).withColumn("row", F.when(F.col("problem").isNull(), F.from_json(column, schemas.ROW)))


def strict_rows(payloads: DataFrame, column: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows of payloads, with the columns `keep`; raises at the first that is not exactly one."""
    checked = decoded(payloads, column)
    sure = F.when(F.col("problem").isNotNull(), F.raise_error(F.col("problem")).cast(schemas.ROW.simpleString())).otherwise(F.col("row"))
    return checked.select(*keep, sure.alias("row")).select(*keep, "row.*")


def read_interim(spark: SparkSession, folder: str, skip: str = "chunked.rows.jsonl") -> DataFrame:
    """payload, file_name, line_no of all row files of a folder, without the next stage's own output.

    A row file may be one file or a folder of parts, as a stage writes it. Lines are numbered by part, by the block in
    which they were read, and by their place in it.
    """
    source = F.col("_metadata.file_path")
    lines = spark.read.text(f"{folder.rstrip('/')}/*.rows.jsonl").select(F.col("value").alias("payload"), F.regexp_extract(source, r"([^/]+\.rows\.jsonl)(?:/[^/]*)?\z", 1).alias("file_name"), source.alias("_part"), F.col("_metadata.file_block_start").alias("_block"))
    kept = lines.where((F.col("file_name") != skip) & (F.col("payload") != "")).withColumn("_at", F.struct("_part", "_block", F.monotonically_increasing_id().alias("n")))
    numbered = ordered.running_sum(kept.drop("_part", "_block"), "line_no", F.lit(1), ["file_name"], "_at")
    return numbered.select("payload", "file_name", "line_no")


def read_rejections(spark: SparkSession, folder: str) -> DataFrame:
    """The rejections of all stages of a folder; see `read_interim`."""
    return spark.read.schema(schemas.REJECTION).json(f"{folder.rstrip('/')}/*.rejections.jsonl")


#: Fields of a playbook record and the headings they get (fixed values).
SECTIONS = (("section_about", "About"), ("section_actions", "Suggested Actions"), ("section_doc", "Transparency and Documentation"), ("section_ref", "References"))
PLAYBOOK = "type string, title string, description string, section_about string, section_actions string, section_doc string, section_ref string"


def read_playbook(spark: SparkSession, path: str, doc_id: str) -> DataFrame:
    """The records of a playbook file, a JSON array of objects, with their place."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.lit(doc_id).alias("doc_id"), F.posexplode(F.from_json("value", f"array<struct<{PLAYBOOK}>>")).alias("place", "r")).select("doc_id", F.col("place").cast("bigint").alias("place"), "r.*")


def read_catalogs(spark: SparkSession, path: str) -> DataFrame:
    """file_id, doc_id, mini_catalog of every JSON file: the name of a file without its ending is its document."""
    text = spark.read.text(path, wholetext=True).select("*", F.col("_metadata.file_path").alias("file"))
    name = F.regexp_extract("file", r"([^/]+?)(?:\.json)?\z", 1)
    return text.select(F.xxhash64("file").alias("file_id"), name.alias("doc_id"), F.col("value").alias("mini_catalog"))


def playbook(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejections) of guidance records with `doc_id` and `place` (order in the file, from 0).

    The first record of a title counts, even if it then proves too short (under 200 characters).
    """
    named = records.withColumn("title", T.strip(F.coalesce("title", F.lit(""))))
    first = named.where("title <> ''").groupBy("doc_id", "title").agg(F.min("place").alias("_first"))
    marked = named.join(first, ["doc_id", "title"], "left")
    about = F.regexp_replace(F.concat(F.col("title"), F.lit(": "), T.strip(F.coalesce("description", F.lit("")))), "^[: ]+|[: ]+\\z", "")
    labelled = [F.when(T.strip(F.col(f)) != "", F.concat(F.lit(f"{label}:\n"), T.strip(F.col(f)))) for f, label in SECTIONS]
    built = marked.withColumn("text", T.normalize_text(F.concat_ws("\n\n", about, *labelled)))
    function = T.strip(F.coalesce(F.nullif(F.col("type"), F.lit("")), F.regexp_extract("title", r"^(\S+)", 1)))
    reason = F.when(F.col("title") == "", "missing_title").when(F.col("place") > F.col("_first"), "duplicate_subcategory").when(F.length("text") < 200, "playbook_entry_too_short")
    judged = built.withColumn("rule", reason)
    detail = F.when(F.col("rule") == "missing_title", "record has no title").when(F.col("rule") == "duplicate_subcategory", "title already emitted").otherwise(F.concat(F.length("text").cast("string"), F.lit(" chars")))
    ref = F.when(F.col("title") == "", F.concat(F.lit("record["), F.col("place").cast("string"), F.lit("]"))).otherwise(F.col("title"))
    rejected = judged.where("rule IS NOT NULL").select("doc_id", ref.alias("ref"), "rule", detail.alias("detail"), F.lit("parse_playbook").alias("stage"))
    rows = judged.where("rule IS NULL").select(
        "place", T.make_id(F.col("doc_id"), F.lit("ai_rmf_subcategory"), F.col("title")).alias("id"), "text", "doc_id", F.lit("ai_rmf_subcategory").alias("chunk_type"), F.concat_ws(" > ", F.lit("AI RMF Playbook"), function, F.col("title")).alias("section_path")
    )
    return rows, rejected


def with_document(rows: DataFrame, manifest: DataFrame, provenance: DataFrame, control_id: str | None = None) -> DataFrame:
    """Rows completed with what the manifest and the provenance say of their document, in the published schema."""
    documents = manifest.select("doc_id", F.col("title").alias("doc_title"), "revision", "pub_date", F.col("tier").cast("int").alias("tier"), T.effective_source_url(F.col("url"), F.col("landing_page")).alias("source_url"))
    hashes = provenance.select("doc_id", F.col("sha256").alias("sha256_source"))
    joined = rows.join(documents, "doc_id").join(hashes, "doc_id", "left")
    if control_id is None and "control_id" not in rows.columns:
        joined = joined.withColumn("control_id", F.lit(None).cast("string"))
    return joined.select(*[c for c in rows.columns if c not in schemas.ROW_FIELDS], *schemas.ROW_FIELDS)
