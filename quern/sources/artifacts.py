"""Retrieved artifacts: where they lie, whether they are what was promised, and what a fetch would do about each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import schemas


def extension(format_: Column, url: Column) -> Column:
    """json for catalogs and JSON web sources, html for other web sources, else pdf."""
    return F.when(format_ == "oscal", "json").when(format_ == "web", F.when(F.coalesce(url, F.lit("")).endswith(".json"), "json").otherwise("html")).otherwise("pdf")


def raw_path(folder: str, doc_id: Column, format_: Column, url: Column) -> Column:
    base = folder.rstrip("/") + "/raw/"
    manual = F.concat(F.lit(base + "manual/"), doc_id, F.lit(".pdf"))
    return F.when(format_ == "pdf-manual", manual).otherwise(F.concat(F.lit(base), doc_id, F.lit("."), extension(format_, url)))


def read_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256 and content of every file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), "content")


def on_disk(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, sha256, bytes of the artifacts that lie where `raw_path` puts them; no rows without any."""
    places = manifest.select("doc_id", raw_path(folder, F.col("doc_id"), F.col("format"), F.col("url")).alias("_place"))
    try:
        files = read_artifacts(spark, folder.rstrip("/") + "/raw")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "doc_id string, sha256 string, bytes bigint")
    local = files.select(F.regexp_replace("path", "^file:/+", "/").alias("_path"), "sha256", "bytes")
    return local.join(places, F.col("_path") == F.regexp_replace("_place", "^file:/+", "/")).select("doc_id", "sha256", "bytes")


def sanity_problem(content: Column, format_: Column, url: Column) -> Column:
    """What is wrong with an artifact, null if nothing: a PDF must start like one, a catalog must be JSON with `catalog`
    or `profile`, a web source JSON with something in it or a page."""
    text = F.try_validate_utf8(content.cast("string"))
    parsed = F.try_parse_json(text)
    keys = F.json_object_keys(text)
    head = F.lower(F.decode(F.substring(content, 1, 4096), "iso-8859-1"))
    start = F.regexp_replace(F.decode(F.substring(content, 1, 1024), "iso-8859-1"), r"^\s+", "")
    catalog = F.when(parsed.isNull(), "not valid JSON").when(~F.coalesce(F.arrays_overlap(keys, F.array(F.lit("catalog"), F.lit("profile"))), F.lit(False)), "no top-level catalog or profile")
    empty = F.trim(text).isin("{}", "[]", "null", '""', "0", "false")
    web = F.when(F.coalesce(url, F.lit("")).endswith(".json"), F.when(parsed.isNull(), "not valid JSON").when(empty, "JSON source is empty")).when(~head.contains("<html") & ~head.contains("<!doctype html"), "does not look like HTML")
    return F.when(format_.isin("pdf", "pdf-manual"), F.when(~start.startswith("%PDF"), "does not start with %PDF")).when(format_ == "oscal", catalog).when(format_ == "web", web)


def latest_provenance(provenance: DataFrame) -> DataFrame:
    """The latest entry of each document, by retrieval time; entries without one come first."""
    columns = [c for c in provenance.columns if c != "doc_id"]
    newest = F.max(F.struct(F.coalesce("retrieved_at", F.lit("")).alias("at"), F.coalesce("sha256", F.lit("")).alias("hash"), F.struct(*columns).alias("entry")))
    return provenance.groupBy("doc_id").agg(newest.alias("m")).select("doc_id", "m.entry.*")


def fetch_actions(manifest: DataFrame, provenance: DataFrame, on_disk: DataFrame, include_web: bool = False, force: bool = False) -> DataFrame:
    """doc_id, action: skipped, manual, manual-missing, cached or download, for every document of the manifest.

    `provenance` has one row for each document, `on_disk` doc_id and sha256 of the artifacts there are.
    """
    recorded = provenance.select("doc_id", F.col("sha256").alias("_recorded"))
    actual = on_disk.select("doc_id", F.col("sha256").alias("_actual"))
    joined = manifest.join(recorded, "doc_id", "left").join(actual, "doc_id", "left")
    web = (F.col("format") == "web") & F.lit(not include_web)
    cached = F.lit(not force) & F.col("_recorded").isNotNull() & (F.col("_recorded") == F.col("_actual"))
    action = F.when((F.col("format") == "embedded-in-oscal") | web, "skipped").when(F.col("format") == "pdf-manual", F.when(F.col("_actual").isNull(), "manual-missing").otherwise("manual")).when(F.coalesce(cached, F.lit(False)), "cached").otherwise("download")
    return joined.select("doc_id", "format", action.alias("action"))


def manual_record(manifest: DataFrame, provenance: DataFrame, on_disk: DataFrame, now: str) -> DataFrame:
    """Provenance of documents that people place: an unchanged file keeps the time at which it was first recorded."""
    before = provenance.select("doc_id", F.col("sha256").alias("_before"), F.col("retrieved_at").alias("_at"))
    there = on_disk.select("doc_id", F.col("sha256").alias("_now"), F.col("bytes").alias("_bytes"))
    joined = manifest.where("format = 'pdf-manual'").join(before, "doc_id", "left").join(there, "doc_id", "left")
    missing = F.col("_now").isNull()
    time = F.when(missing, F.lit(None)).when((F.col("_before") == F.col("_now")) & F.col("_at").isNotNull(), F.col("_at")).otherwise(F.lit(now))
    return joined.select(
        "doc_id", F.col("_now").alias("sha256"), F.col("_bytes").alias("bytes"), time.alias("retrieved_at"), F.col("landing_page").alias("url"), F.lit(None).cast("int").alias("http_status"), F.lit("manual").alias("source"),
        missing.alias("skipped"), F.when(missing, "awaiting manual placement").otherwise("human-placed artifact").alias("note"),
    )


def deferred_record(manifest: DataFrame) -> DataFrame:
    """Provenance of web sources that are not asked for."""
    none = lambda kind: F.lit(None).cast(kind)
    return manifest.where("format = 'web'").select(
        "doc_id", none("string").alias("sha256"), none("bigint").alias("bytes"), none("string").alias("retrieved_at"), "url", none("int").alias("http_status"), F.lit("skipped").alias("source"), F.lit(True).alias("skipped"), F.lit("web source deferred").alias("note")
    )


PROVENANCE_FIELDS = tuple(schemas.PROVENANCE_ENTRY.fieldNames())


def read_provenance(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of a provenance file, a JSON object keyed by doc_id; no rows if there is none."""
    empty = spark.createDataFrame([], "doc_id string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.PROVENANCE_ENTRY))
    try:
        text = spark.read.text(path, wholetext=True)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return empty
        raise
    kind = f"map<string,{schemas.PROVENANCE_ENTRY.simpleString()}>"
    return text.select(F.explode(F.from_json("value", kind)).alias("doc_id", "e")).select("doc_id", "e.*")
