"""Queries of sources: payloads of interim files, the manifest, provenance, and guidance records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import schemas
from quern.plans.chunk_sql import strip
from quern.plans.text import normal_sql
from quern.sources import artifacts, manifest, records


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def decoded_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interim payloads read strictly: the row, or why there is none."""
    read = records.decoded(_table(spark, sf_dir, "interim_records"))
    return read.select("rec_id", F.col("problem").isNull().alias("good"), "row.id", "row.chunk_type", F.coalesce("row.tier", F.lit(-1)).alias("tier"), F.coalesce(F.length("row.text"), F.lit(-1)).alias("chars"))


def manifest_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All problems of the manifest's rows as they are and of copies of all rows that are spoilt in every way, one at a time."""
    docs = _table(spark, sf_dir, "manifest_docs")
    spoilt = {
        "format": F.concat(F.lit("old-"), "format"), "tier": F.col("tier") + 2, "url": F.concat(F.lit("ftp"), "url"), "landing_page": F.lit("http://x.example"), "none": F.lit(None).cast("string"),
    }
    rows = docs
    for name, value in spoilt.items():
        copy = docs.withColumn("doc_id", F.concat("doc_id", F.lit(f"/{name}")))
        rows = rows.unionByName(copy.withColumn("url", value).withColumn("landing_page", value) if name == "none" else copy.withColumn(name, value))
    return manifest.problems(rows.unionByName(docs.withColumn("format", F.lit(None).cast("string")).withColumn("tier", F.lit(None).cast("int"))))


def provenance_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifacts.latest_provenance(_table(spark, sf_dir, "provenance")).select("doc_id", "sha256", "retrieved_at")


def artifact_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "manifest_docs")
    return docs.select("doc_id", artifacts.raw_path("data", F.col("doc_id"), F.col("format"), F.col("url")).alias("path"))


def sane_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with artifacts: catalog texts as if fetched, and chunks as PDF files, JSON sources and pages, each with a form that
    is right and one that is not."""
    files = _table(spark, sf_dir, "catalog_files").select(F.col("file_id").alias("no"), F.lit("oscal").alias("format"), F.lit("").alias("url"), F.coalesce("mini_catalog", F.lit("")).alias("text"))
    chunks = _table(spark, sf_dir, "chunks").where("text IS NOT NULL")
    forms = [("pdf", "", "%PDF-1.7 "), ("pdf-manual", "", " \n%PDF"), ("pdf", "", "<html>"), ("web", "p.json", "["), ("web", "p.json", "[]"), ("web", "p.html", "<!DOCTYPE html>"), ("web", "p.html", "{}")]
    dressed = F.explode(F.array(*[F.struct(F.lit(f).alias("format"), F.lit(u).alias("url"), F.lit(t).alias("head")) for f, u, t in forms])).alias("x")
    # A head that is all of its source is not followed by the text.
    whole = F.when(F.col("x.head") == "[]", F.col("x.head")).otherwise(F.concat("x.head", "text"))
    made = chunks.select("row_no", "text", dressed).select(F.col("row_no").alias("no"), "x.format", "x.url", whole.alias("text"))
    every = files.unionByName(made)
    return every.select("no", "format", F.col("text").substr(1, 5).alias("start"), artifacts.sanity_problem(F.encode("text", "utf-8"), F.col("format"), F.col("url")).alias("problem"))


def guidance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as guidance records: titled texts with sections; the first of a title counts."""
    return _guidance(spark, sf_dir)[0].select("doc_id", "id", "section_path", F.length("text").alias("chars"))


def guidance_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _guidance(spark, sf_dir)[1].groupBy("doc_id", "rule").agg(F.count("*").alias("n"))


def _guidance(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = _table(spark, sf_dir, "documents")
    record = docs.select(F.coalesce("pub_id", F.lit("none")).alias("doc_id"), F.col("doc_id").alias("place"), F.lit("Govern").alias("type"), "title", F.col("source").alias("description"), F.col("text").alias("section_about"), F.lit(None).cast("string").alias("section_actions"), F.lit("  ").alias("section_doc"), F.lit("see above").alias("section_ref"))
    return records.playbook(record)


def completed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with what the manifest and the latest provenance say of their document."""
    bare = _table(spark, sf_dir, "chunks").select("row_no", "id", "text", "doc_id", "chunk_type", "control_id", "section_path")
    full = records.with_document(bare, _table(spark, sf_dir, "manifest_docs").dropDuplicates(["doc_id"]), artifacts.latest_provenance(_table(spark, sf_dir, "provenance")))
    return full.select("row_no", "doc_id", "doc_title", "revision", "tier", "source_url", "sha256_source")


QUERIES = {f.__name__: f for f in (decoded_payloads, manifest_problems, provenance_latest, artifact_paths, sane_artifacts, guidance_rows, guidance_rejections, completed_rows)}
_FIELDS = ", ".join(f"'{f}'" for f in sorted(schemas.ROW_FIELDS))
ORACLES = {
    "decoded_payloads": f"""WITH g AS (SELECT rec_id, CASE WHEN json_valid(payload) AND list_sort(json_keys(payload)) = [{_FIELDS}] THEN payload END AS p FROM interim_records)
SELECT rec_id, p IS NOT NULL AS good, p->>'id' AS id, p->>'chunk_type' AS chunk_type, coalesce(CASE WHEN json_type(p->'tier') <> 'VARCHAR' THEN (p->>'tier')::INT END, -1) AS tier, coalesce(length(p->>'text'), -1)::INT AS chars FROM g""",
    "manifest_problems": r"""WITH manifest AS (
SELECT doc_id, format, tier, url, landing_page FROM manifest_docs UNION ALL SELECT doc_id || '/format', 'old-' || format, tier, url, landing_page FROM manifest_docs UNION ALL SELECT doc_id || '/tier', format, tier + 2, url, landing_page FROM manifest_docs
UNION ALL SELECT doc_id || '/url', format, tier, 'ftp' || url, landing_page FROM manifest_docs UNION ALL SELECT doc_id || '/landing_page', format, tier, url, 'http://x.example' FROM manifest_docs UNION ALL SELECT doc_id || '/none', format, tier, NULL, NULL FROM manifest_docs
UNION ALL SELECT doc_id, NULL, NULL, url, landing_page FROM manifest_docs),
p AS (
SELECT doc_id, 'format ' || coalesce(format, 'null') || ' is unknown' AS problem FROM manifest WHERE coalesce(format NOT IN ('oscal', 'pdf', 'embedded-in-oscal', 'pdf-manual', 'web'), true)
UNION ALL SELECT doc_id, 'tier must be 1 or 2, got ' || coalesce(tier::VARCHAR, 'null') FROM manifest WHERE coalesce(tier NOT IN (1, 2), true)
UNION ALL SELECT doc_id, 'url must be https or null, got ' || url FROM manifest WHERE NOT starts_with(url, 'https://')
UNION ALL SELECT doc_id, 'landing_page must be https or null, got ' || landing_page FROM manifest WHERE NOT starts_with(landing_page, 'https://')
UNION ALL SELECT doc_id, 'format ' || format || ' requires a url' FROM manifest WHERE format IN ('oscal', 'pdf', 'web') AND coalesce(url, '') = ''
UNION ALL SELECT doc_id, 'format pdf-manual requires a landing_page' FROM manifest WHERE format = 'pdf-manual' AND coalesce(landing_page, '') = ''
UNION ALL SELECT doc_id, 'duplicate doc_id' FROM manifest GROUP BY doc_id HAVING count(*) > 1) SELECT * FROM p""",
    "provenance_latest": "SELECT doc_id, sha256, retrieved_at FROM provenance QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(retrieved_at, '') DESC, coalesce(sha256, '') DESC) = 1",
    "artifact_paths": "SELECT doc_id, CASE WHEN format = 'pdf-manual' THEN 'data/raw/manual/' || doc_id || '.pdf' ELSE 'data/raw/' || doc_id || '.' || CASE WHEN format = 'oscal' THEN 'json' WHEN format = 'web' THEN CASE WHEN ends_with(coalesce(url, ''), '.json') THEN 'json' ELSE 'html' END ELSE 'pdf' END END AS path FROM manifest_docs",
    "sane_artifacts": """SELECT file_id AS no, 'oscal' AS format, left(coalesce(mini_catalog, ''), 5) AS start, CASE WHEN mini_catalog IS NULL OR NOT json_valid(mini_catalog) THEN 'not valid JSON' WHEN NOT coalesce(list_has_any(json_keys(mini_catalog), ['catalog', 'profile']), false) THEN 'no top-level catalog or profile' END AS problem FROM catalog_files
UNION ALL SELECT row_no, format, left(body, 5), CASE WHEN format LIKE 'pdf%' THEN CASE WHEN NOT starts_with(ltrim(body, ' ' || chr(10)), '%PDF') THEN 'does not start with %PDF' END WHEN url = 'p.json' THEN CASE WHEN NOT json_valid(body) THEN 'not valid JSON' WHEN body = '[]' THEN 'JSON source is empty' END
  WHEN NOT contains(lower(left(body, 4096)), '<html') AND NOT contains(lower(left(body, 4096)), '<!doctype html') THEN 'does not look like HTML' END
FROM (SELECT row_no, format, url, CASE WHEN head = '[]' THEN head ELSE head || text END AS body FROM chunks, (VALUES ('pdf', '', '%PDF-1.7 '), ('pdf-manual', '', ' ' || chr(10) || '%PDF'), ('pdf', '', '<html>'), ('web', 'p.json', '['), ('web', 'p.json', '[]'), ('web', 'p.html', '<!DOCTYPE html>'), ('web', 'p.html', '{}')) AS v(format, url, head) WHERE text IS NOT NULL)""",
    "completed_rows": """WITH p AS (SELECT doc_id, sha256 FROM provenance QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(retrieved_at, '') DESC, coalesce(sha256, '') DESC) = 1)
SELECT row_no, c.doc_id, m.title AS doc_title, m.revision, m.tier, coalesce(nullif(m.url, ''), nullif(m.landing_page, ''), '') AS source_url, p.sha256 AS sha256_source FROM chunks c JOIN manifest_docs m USING (doc_id) LEFT JOIN p ON p.doc_id = c.doc_id""",
}

_GUIDED = rf"""WITH d AS (SELECT coalesce(pub_id, 'none') AS doc_id, doc_id AS place, {strip("coalesce(title, '')")} AS title, {strip("coalesce(source, '')")} AS description, {strip("coalesce(text, '')")} AS about FROM documents),
b AS (SELECT *, regexp_replace(title || ': ' || description, '^[: ]+|[: ]+$', '', 'g') || CASE WHEN about <> '' THEN chr(10) || chr(10) || 'About:' || chr(10) || about ELSE '' END || chr(10) || chr(10) || 'References:' || chr(10) || 'see above' AS raw,
  CASE WHEN title <> '' THEN min(place) OVER (PARTITION BY doc_id, title) END AS first FROM d),
t AS (SELECT doc_id, place, title, first, {normal_sql('raw')} AS text FROM b),
j AS (SELECT *, CASE WHEN title = '' THEN 'missing_title' WHEN place > first THEN 'duplicate_subcategory' WHEN length(text) < 200 THEN 'playbook_entry_too_short' END AS rule FROM t)"""
ORACLES |= {
    "guidance_rows": _GUIDED + " SELECT doc_id, doc_id || '/ai_rmf_subcategory/' || trim(regexp_replace(regexp_replace(lower(strip_accents(title)), '[^\\x00-\\x7f]', '', 'g'), '[^a-z0-9.]+', '-', 'g'), '-') AS id, 'AI RMF Playbook > Govern > ' || title AS section_path, length(text)::INT AS chars FROM j WHERE rule IS NULL",
    "guidance_rejections": _GUIDED + " SELECT doc_id, rule, count(*) AS n FROM j WHERE rule IS NOT NULL GROUP BY ALL",
}
