"""Queries that write the files between stages and read them back, so that sources and sinks prove each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import schemas
from quern.operators import quality
from quern.session import fresh_path
from quern.sources import artifacts, manifest, records, sinks


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks that have all that a published row must have."""
    return _table(spark, sf_dir, "chunks").where(" AND ".join(f"{c} IS NOT NULL" for c in schemas.REQUIRED))


def _file(spark: SparkSession, text: str, name: str) -> str:
    """A small text as a file of the shared folder."""
    path = fresh_path(spark, name)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def exported_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as the published Parquet file and read back."""
    path = fresh_path(spark, "export")
    sinks.write_parquet(_complete(spark, sf_dir), path)
    return spark.read.parquet(path).select("id", F.md5("text").alias("md5"), "doc_id", "tier", "chunk_type", "control_id", "section_path")


def interim_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as the row files of two stages, read back strictly; the chunking stage's own file is passed over."""
    folder = fresh_path(spark, "interim")
    rows = _complete(spark, sf_dir)
    sinks.write_jsonl(rows.where("tier = 1"), f"{folder}/first.rows.jsonl")
    sinks.write_jsonl(rows.where("tier <> 1"), f"{folder}/second.rows.jsonl")
    sinks.write_jsonl(rows, f"{folder}/chunked.rows.jsonl")
    lines = records.read_interim(spark, folder)
    return records.strict_rows(lines, keep=("file_name",)).select("file_name", "id", F.md5("text").alias("md5"), "doc_id", "tier", "control_id", "section_path")


def interim_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the lines of those files are numbered: without gaps from 1."""
    folder = fresh_path(spark, "interim")
    rows = _complete(spark, sf_dir)
    sinks.write_jsonl(rows.where("tier = 1"), f"{folder}/first.rows.jsonl")
    sinks.write_jsonl(rows.where("tier <> 1"), f"{folder}/second.rows.jsonl")
    return records.read_interim(spark, folder).groupBy("file_name").agg(F.count("*").alias("lines"), F.countDistinct("line_no").alias("different"), F.min("line_no").alias("first"), F.max("line_no").alias("last"))


def earlier_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejection log written as the files of its stages and read back, by stage and rule."""
    folder = fresh_path(spark, "rejections")
    log = _table(spark, sf_dir, "rejections")
    sinks.write_jsonl(log, f"{folder}/all.rejections.jsonl", schemas.REJECTION_FIELDS)
    return records.read_rejections(spark, folder).groupBy("stage", "rule").agg(F.count("*").alias("n"), F.count("detail").alias("detailed"))


def manifest_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest written as its file and read back with all its checks."""
    docs = _table(spark, sf_dir, "manifest_docs").select(*schemas.DOCUMENT_FIELDS)
    # One object of the publications, which are few.
    whole = docs.agg(F.to_json(F.struct(F.lit("1").alias("manifest_version"), F.lit("d").alias("dataset_name"), F.lit("m").alias("maintainer"), F.collect_list(F.struct(*schemas.DOCUMENT_FIELDS)).alias("documents")), {"ignoreNullFields": "false"}).alias("v"))
    return manifest.read_manifest(spark, _file(spark, whole.first()["v"], "manifest"))


def provenance_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest provenance written as its file and read back."""
    latest = artifacts.latest_provenance(_table(spark, sf_dir, "provenance"))
    return artifacts.read_provenance(spark, _file(spark, sinks.provenance_json(latest), "provenance"))


def summary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a build whose valid rows are the complete chunks, line by line."""
    rows = _complete(spark, sf_dir)
    text = quality.summary_markdown(rows, _table(spark, sf_dir, "rejections"), quality.expected_counts(rows))
    return spark.createDataFrame(list(enumerate(text.rstrip("\n").split("\n"), 1)), "line int, text string")


def manual_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What would be recorded of documents that people place, if their last recorded file lay there."""
    latest = artifacts.latest_provenance(_table(spark, sf_dir, "provenance"))
    docs = _table(spark, sf_dir, "manifest_docs")
    # Of documents fetched as catalogs another file lies there now, of the others the same.
    there = latest.where("sha256 IS NOT NULL").join(docs.select("doc_id", F.col("format").alias("was")), "doc_id").select("doc_id", F.when(F.col("was") == "oscal", F.lit("new")).otherwise(F.col("sha256")).alias("sha256"), F.col("bytes"))
    return artifacts.manual_record(docs.withColumn("format", F.lit("pdf-manual")), latest, there, "2030-01-01T00:00:00+00:00")


QUERIES = {f.__name__: f for f in (exported_rows, interim_rows, interim_lines, earlier_rejections, manifest_read, provenance_read, summary_lines, manual_records)}
_WHOLE = " AND ".join(f"{c} IS NOT NULL" for c in schemas.REQUIRED)
_LATEST = "p AS (SELECT * FROM provenance QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(retrieved_at, '') DESC, coalesce(sha256, '') DESC) = 1)"
ORACLES = {
    "exported_rows": f"SELECT id, md5(text) AS md5, doc_id, tier, chunk_type, control_id, section_path FROM chunks WHERE {_WHOLE}",
    "interim_rows": f"SELECT CASE WHEN tier = 1 THEN 'first' ELSE 'second' END || '.rows.jsonl' AS file_name, id, md5(text) AS md5, doc_id, tier, control_id, section_path FROM chunks WHERE {_WHOLE}",
    "interim_lines": f"SELECT CASE WHEN tier = 1 THEN 'first' ELSE 'second' END || '.rows.jsonl' AS file_name, count(*) AS lines, count(*) AS different, 1::BIGINT AS first, count(*) AS last FROM chunks WHERE {_WHOLE} GROUP BY 1",
    "earlier_rejections": "SELECT stage, rule, count(*) AS n, count(detail) AS detailed FROM rejections GROUP BY ALL",
    "manifest_read": f"SELECT {', '.join(schemas.DOCUMENT_FIELDS)} FROM manifest_docs",
    "provenance_read": f"WITH {_LATEST} SELECT doc_id, {', '.join(artifacts.PROVENANCE_FIELDS)} FROM p",
    "manual_records": f"""WITH {_LATEST} SELECT m.doc_id, CASE WHEN p.sha256 IS NULL THEN NULL WHEN m.format = 'oscal' THEN 'new' ELSE p.sha256 END AS sha256, CASE WHEN p.sha256 IS NOT NULL THEN p.bytes END AS bytes,
  CASE WHEN p.sha256 IS NULL THEN NULL WHEN m.format = 'oscal' OR p.retrieved_at IS NULL THEN '2030-01-01T00:00:00+00:00' ELSE p.retrieved_at END AS retrieved_at, landing_page AS url, NULL::INT AS http_status, 'manual' AS source, p.sha256 IS NULL AS skipped, CASE WHEN p.sha256 IS NULL THEN 'awaiting manual placement' ELSE 'human-placed artifact' END AS note
FROM manifest_docs m LEFT JOIN p USING (doc_id)""",
    "summary_lines": rf"""WITH c AS (SELECT * FROM chunks WHERE {_WHOLE}),
e AS (SELECT 'control_rows' AS name, '' AS subject, count_if(chunk_type IN ('control', 'control_enhancement'))::BIGINT AS value, 900 AS low, 1200 AS high FROM c
  UNION ALL SELECT 'families', '', count(DISTINCT split_part(control_id, '-', 1)) FILTER (chunk_type = 'control' AND control_id <> ''), 20, 20 FROM c
  UNION ALL SELECT 'ssdf_practices', '', count_if(chunk_type = 'ssdf_practice')::BIGINT, 40, NULL FROM c
  UNION ALL SELECT 'ai_rmf_subcategories', doc_id, count(DISTINCT split_part(id, ' (part ', 1)), 60, 80 FROM c WHERE chunk_type = 'ai_rmf_subcategory' GROUP BY doc_id),
w AS (SELECT '- ' || name || ' ' || subject || ': ' || value || ' outside [' || low || ', ' || coalesce(high::VARCHAR, '∞') || ']' AS text, name, subject FROM e WHERE value < low OR coalesce(value > high, false)),
l AS (SELECT 0 AS part, '' AS a, '' AS b, unnest(['# Dataset summary', '', '- Rows published: **' || format('{{:,}}', (SELECT count(*) FROM c)) || '**', '- Rows rejected across all stages: **' || format('{{:,}}', (SELECT count(*) FROM rejections)) || '**', '- Total text: **' || format('{{:.1f}}', (SELECT sum(strlen(text)) FROM c) / 1e6) || ' MB**', '', '## Rows by document', '', '| doc_id | rows |', '|---|---:|']) AS text, generate_subscripts(range(10), 1) AS k
  UNION ALL SELECT 1, doc_id, '', '| `' || doc_id || '` | ' || format('{{:,}}', count(*)) || ' |', 0 FROM c GROUP BY doc_id
  UNION ALL SELECT 2, '', '', unnest(['', '## Rows by chunk type', '', '| chunk_type | rows |', '|---|---:|']), generate_subscripts(range(5), 1)
  UNION ALL SELECT 3, chunk_type, '', '| `' || chunk_type || '` | ' || format('{{:,}}', count(*)) || ' |', 0 FROM c GROUP BY chunk_type
  UNION ALL SELECT 4, '', '', unnest(['', '## Rejections by rule', '', '| stage | rule | count |', '|---|---|---:|']), generate_subscripts(range(5), 1)
  UNION ALL SELECT 5, stage, rule, '| ' || stage || ' | `' || rule || '` | ' || format('{{:,}}', count(*)) || ' |', 0 FROM rejections GROUP BY stage, rule
  UNION ALL SELECT 6, '', '', unnest(['', '## Expected-count warnings', '']), generate_subscripts(range(3), 1)
  UNION ALL SELECT 7, name, subject, text, 0 FROM w UNION ALL SELECT 7, '', '', '- none', 0 WHERE NOT EXISTS (SELECT 1 FROM w))
SELECT row_number() OVER (ORDER BY part, a, b, k)::INT AS line, text FROM l""",
}
