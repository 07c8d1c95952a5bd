"""Queries of chunking, validation, duplicates and counts, over chunks, manifest_docs, provenance and rejections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import schemas
from quern.functions import text as T
from quern.operators import chunking, dedupe, quality, rules
from quern.plans import chunk_sql
from quern.sources import artifacts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with the order of the build: by document, then by delivery, which gives `seq`."""
    return _table(spark, sf_dir, "chunks").withColumn("seq", F.col("row_no"))


def tagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row rule that each chunk fails."""
    judged = rules.tagged(_rows(spark, sf_dir), _table(spark, sf_dir, "manifest_docs"), _table(spark, sf_dir, "provenance"))
    return judged.select("row_no", F.col("failed.rule").alias("rule"))


#: What is done to copies of all chunks so that each rule is met: column -> SQL value, alike in Spark and DuckDB.
_SPOILT: list[dict[str, str]] = [
    {}, {"id": "CAST(NULL AS STRING)"}, {"tier": "5"}, {"control_id": "'zz-1'"}, {"text": "'APPENDIX B PAGE B-2 Too short.'"}, {"text": "'Too short.'"}, {"text": "concat(text, ' {{ name }}')"}, {"text": "concat('NIST SP 800-53 Rev. 5   Page 7', chr(10), text)"},
    {"text": "concat('[NISTIR 7298] See (2019) available at ', text)"}, {"text": "concat('and so ', text)", "chunk_type": "'section'", "control_id": "CAST(NULL AS STRING)"}, {"sha256_source": "'unknown'"}, {"doc_id": "'nowhere'"}, {"chunk_type": "'poem'"}, {"section_path": "'A > b > C'", "text": "'CHAPTER 1 Short.'"},
]
_JUDGED = ("id", "text", "doc_id", "doc_title", "revision", "pub_date", "tier", "chunk_type", "control_id", "section_path", "source_url", "sha256_source")


def tagged_spoilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rule that each chunk fails as it is, and after each of the ways to spoil it."""
    chunks = _table(spark, sf_dir, "chunks")
    copies = [chunks.selectExpr(f"row_no * 100 + {k} AS row_no", *[f"{how.get(c, c)} AS {c}" for c in _JUDGED]) for k, how in enumerate(_SPOILT)]
    rows = copies[0]
    for copy in copies[1:]:
        rows = rows.unionByName(copy)
    judged = rules.tagged(rows.withColumn("seq", F.col("row_no")), _table(spark, sf_dir, "manifest_docs"), _table(spark, sf_dir, "provenance"))
    return judged.select("row_no", F.col("failed.rule").alias("rule"))


_HEADER = r"(?i)^(?:APPENDIX|CHAPTER)\s+[A-Za-z0-9-]{1,10}\s+(?:PAGE\s+[A-Za-z0-9-]{1,10}\s+)?"
_TAG = r"^\[[A-Z0-9][A-Za-z0-9 .\-]{0,40}\]\s*"
_TAGGED = rf"""
m AS (SELECT doc_id, min(coalesce(format, '')) AS fmt FROM manifest_docs WHERE doc_id IS NOT NULL GROUP BY doc_id),
h AS (SELECT DISTINCT sha256 FROM provenance WHERE sha256 IS NOT NULL),
j AS (SELECT c.*, m.fmt, h.sha256 IS NOT NULL AS known, CASE WHEN chunk_type IN {schemas.STRUCTURED_TYPES} THEN 80 ELSE 200 END AS floor,
  regexp_replace(regexp_replace(text, '{_HEADER}', ''), '^\s+', '') AS body FROM chunks c LEFT JOIN m USING (doc_id) LEFT JOIN h ON h.sha256 = c.sha256_source),
t AS (SELECT *, CASE
  WHEN id IS NULL OR text IS NULL OR doc_id IS NULL OR doc_title IS NULL OR revision IS NULL OR pub_date IS NULL OR tier IS NULL OR chunk_type IS NULL OR source_url IS NULL OR sha256_source IS NULL THEN 'schema_valid'
  WHEN chunk_type NOT IN {schemas.CHUNK_TYPES} OR tier NOT IN (1, 2) THEN 'schema_valid'
  WHEN fmt IS NULL OR NOT known THEN 'doc_in_manifest'
  WHEN control_id IS NOT NULL AND NOT regexp_matches(control_id, '^({"|".join(schemas.CONTROL_FAMILIES)})-\d+(\.\d+)?$') THEN 'control_family_whitelist'
  WHEN control_id IS NOT NULL AND fmt NOT IN ('oscal', 'embedded-in-oscal') THEN 'control_id_source'
  WHEN (regexp_matches(text, '{_HEADER}') OR regexp_matches(coalesce(section_path, ''), '(?:^|\s>\s)[A-Za-z0-9](?:\s>\s|$)')) AND length(body) < floor THEN 'running_header_fragment'
  WHEN length(text) NOT BETWEEN floor AND 8000 THEN 'length_bounds'
  WHEN contains(text, '{{{{') OR contains(text, '}}}}') OR contains(text, 'insert: param') OR contains(text, 'You are a') OR contains(text, 'As an AI') THEN 'no_template_residue'
  WHEN regexp_matches(text, '(?i)^NIST SP 800-\d+[^\n]*Page \d+') OR regexp_matches(text, '^\s*\d+\s*$') OR regexp_matches(text, '(?i)this publication is available free of charge') THEN 'no_furniture'
  WHEN CASE WHEN regexp_matches(text, '{_TAG}') THEN regexp_matches(substr(regexp_replace(text, '{_TAG}', ''), 1, 300), '(?i)(available at|https?://|\(\d{{4}}\)|\bU\.S\. Code\b|\bed\.\b|\bpp\.\s*\d|\bvol\.\s*\d)') ELSE regexp_matches(text, '^[A-Z][A-Za-z''’\-]+,\s+[A-Z]\.(\s*[A-Z]\.)*[,\s]+(\(\d{{4}}\)|[\"“])') END THEN 'bibliography_entry'
  WHEN chunk_type = 'section' AND (regexp_matches(text, '^[a-z]') OR regexp_matches(text, '^\d[\d,.\-]*\s+[a-z]')) THEN 'midsentence_fragment'
  END AS rule FROM j)"""


def _validated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return rules.validate(_rows(spark, sf_dir), _table(spark, sf_dir, "manifest_docs"), _table(spark, sf_dir, "provenance"))


def validated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks that pass every rule."""
    return _validated(spark, sf_dir)[0].select("row_no", "id", "doc_id")


def rejections_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejection of the validation stage, counted by rule."""
    return quality.rejections_by(_validated(spark, sf_dir)[1], "stage", "rule")


#: Which rows stay is found by windows, which is exact where no row shares its two keys with different accepted rows; why
#: the others go is then asked against the rows that stay, as only those count.
_VALID = (
    "WITH "
    + _TAGGED
    + r""",
p AS (SELECT row_no, id, doc_id, lower(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')) AS print,
  NOT (contains(text, chr(65533)) OR regexp_matches(text, '[\x00-\x08\x0b-\x1f\x7f-\x9f\p{Cf}\p{Co}]')) AS clean FROM t WHERE rule IS NULL),
w AS (SELECT *, min(row_no) FILTER (clean) OVER (PARTITION BY id) AS first_id, min(row_no) FILTER (clean) OVER (PARTITION BY print) AS first_print FROM p),
a AS (SELECT * FROM w WHERE clean AND NOT coalesce(first_id < row_no, false) AND NOT coalesce(first_print < row_no, false)),
v AS (SELECT w.*, CASE WHEN i.row_no < w.row_no THEN 'unique_id' WHEN x.row_no < w.row_no THEN 'near_dupe' WHEN NOT w.clean THEN 'encoding_clean' END AS late FROM w LEFT JOIN a AS i ON i.id = w.id LEFT JOIN a AS x ON x.print = w.print)
"""
)


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy rejection over documents by id and fingerprint: verdict of each."""
    docs = _table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.coalesce("title", F.lit("")).alias("title"), T.fingerprint(F.col("text")).alias("print"))
    return dedupe.greedy(docs, "doc_id", "title", "print").select("doc_id", "verdict")


def chunked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks normalised, stripped, merged and split."""
    return _printed(chunking.chunk_rows(_rows(spark, sf_dir))[0])


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts cut at a tenth of the usual limit, so that most of them are: between paragraphs, sentences and words."""
    return _printed(chunking.split_rows(_table(spark, sf_dir, "chunks"), 800, 600))


def split_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts cut so short that sentences are too long, and some words."""
    return _printed(chunking.split_rows(_table(spark, sf_dir, "chunks"), 60, 40))


def _printed(rows: DataFrame) -> DataFrame:
    return rows.select("row_no", "id", "part", "chunk_type", "section_path", F.length("text").alias("chars"), F.sha2("text", 256).alias("sha256"))


def trailing_stubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short sections without a section to fold into."""
    return _merged(spark, sf_dir)[1]


def merged_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir)[0]


def _merged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Whole texts of the whole table, judged and folded."""
    merged, rejected = chunking.merge_short_sections(_rows(spark, sf_dir))
    return merged.select("row_no", "doc_id", "chunk_type", "text"), rejected.select("doc_id", "ref", "rule").distinct()


_MERGE = f"WITH r AS (SELECT row_no, doc_id, id, chunk_type, text FROM chunks),\n{chunk_sql.ISLANDS}"


def incremental_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a fetch would do for every document of the manifest: skip, take from the cache, fetch, or wait for a person."""
    latest = artifacts.latest_provenance(_table(spark, sf_dir, "provenance"))
    return artifacts.fetch_actions(_table(spark, sf_dir, "manifest_docs"), latest, latest).select("doc_id", "action")


def fetch_action_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_skip(spark, sf_dir).groupBy("action").agg(F.count("*").alias("n"))


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three chunks of each type, for a reader to look at."""
    return quality.samples(_rows(spark, sf_dir), "chunk_type", "seq", 3).select("chunk_type", "row_no")


def counts_by_document_and_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rows_by_document_and_type(_rows(spark, sf_dir))


def family_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.family_counts(_rows(spark, sf_dir))


def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.length_stats(_rows(spark, sf_dir))


def text_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.text_bytes(_rows(spark, sf_dir))


def expected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expected_counts(_rows(spark, sf_dir)).fillna(-1, ["low", "high"])


def control_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sorted_controls(_rows(spark, sf_dir), "control_id")


def export_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with their place in the published order; no task sorts them all."""
    return quality.export_positions(_rows(spark, sf_dir), "row_no").select("place", "row_no", "doc_id", "id")


def rejected_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For everything the rejection log refers to: whether there is a chunk of that id, and the first one."""
    asked = _table(spark, sf_dir, "rejections").select(F.col("ref").alias("id"))
    return quality.by_ids(_rows(spark, sf_dir), asked).select("id", "found", "row_no", "chunk_type")


def logged_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejection log without entries that were logged twice, by stage and rule."""
    log = _table(spark, sf_dir, "rejections").dropDuplicates(["doc_id", "ref", "rule", "detail", "stage", "logged_at"])
    return quality.rejections_by(log, "stage", "rule")


def rows_without_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks whose document the manifest does not know."""
    return _table(spark, sf_dir, "chunks").join(_table(spark, sf_dir, "manifest_docs"), "doc_id", "left_anti").select("row_no", "doc_id")


def rows_of_retrieved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks whose source hash was retrieved."""
    hashes = _table(spark, sf_dir, "provenance").where("sha256 IS NOT NULL").select(F.col("sha256").alias("sha256_source"))
    return _table(spark, sf_dir, "chunks").join(hashes, "sha256_source", "left_semi").select("row_no")


QUERIES = {
    f.__name__: f
    for f in (
        tagged_rows, tagged_spoilt, validated_rows, rejections_by_rule, near_duplicates, chunked_rows, split_rows, split_words, trailing_stubs, merged_sections, incremental_skip, fetch_action_counts, sample_rows, counts_by_document_and_type, family_counts, length_stats,
        text_bytes, expected_counts, control_list, export_order, rejected_ids, logged_rejections, rows_without_manifest, rows_of_retrieved,
    )
}
ORACLES = {
    "incremental_skip": """WITH p AS (SELECT doc_id, sha256 FROM provenance QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(retrieved_at, '') DESC, coalesce(sha256, '') DESC) = 1)
SELECT m.doc_id, CASE WHEN format IN ('embedded-in-oscal', 'web') THEN 'skipped' WHEN format = 'pdf-manual' THEN CASE WHEN sha256 IS NULL THEN 'manual-missing' ELSE 'manual' END WHEN sha256 IS NOT NULL THEN 'cached' ELSE 'download' END AS action FROM manifest_docs m LEFT JOIN p USING (doc_id)""",
    "fetch_action_counts": """WITH p AS (SELECT doc_id, sha256 FROM provenance QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(retrieved_at, '') DESC, coalesce(sha256, '') DESC) = 1)
SELECT CASE WHEN format IN ('embedded-in-oscal', 'web') THEN 'skipped' WHEN format = 'pdf-manual' THEN CASE WHEN sha256 IS NULL THEN 'manual-missing' ELSE 'manual' END WHEN sha256 IS NOT NULL THEN 'cached' ELSE 'download' END AS action, count(*) AS n FROM manifest_docs m LEFT JOIN p USING (doc_id) GROUP BY 1""",
    "sample_rows": "SELECT chunk_type, row_no FROM chunks QUALIFY row_number() OVER (PARTITION BY chunk_type ORDER BY row_no) <= 3",
    "tagged_rows": "WITH " + _TAGGED + " SELECT row_no, rule FROM t",
    "tagged_spoilt": "WITH spoilt AS ("
    + " UNION ALL ".join("SELECT row_no * 100 + " + str(k) + " AS row_no, " + ", ".join(f"{how.get(c, c)} AS {c}" for c in _JUDGED) + " FROM chunks" for k, how in enumerate(_SPOILT))
    + "),"
    + _TAGGED.replace("FROM chunks c", "FROM spoilt c")
    + " SELECT row_no, rule FROM t",
    "validated_rows": _VALID + "SELECT row_no, id, doc_id FROM v WHERE late IS NULL",
    "rejections_by_rule": _VALID + "SELECT 'validate' AS stage, rule, count(*) AS n FROM (SELECT rule FROM t WHERE rule IS NOT NULL UNION ALL SELECT late FROM v WHERE late IS NOT NULL) GROUP BY rule",
    "trailing_stubs": _MERGE + " SELECT DISTINCT i.doc_id, i.id AS ref, 'trailing_furniture' AS rule FROM i LEFT JOIN o ON o.doc_id IS NOT DISTINCT FROM i.doc_id AND o.island = i.island WHERE short AND NOT coalesce(fits, false)",
    "merged_sections": _MERGE + f" SELECT row_no, i.doc_id, chunk_type, {chunk_sql.MERGED} AS text FROM i LEFT JOIN g ON g.doc_id IS NOT DISTINCT FROM i.doc_id AND g.at = row_no WHERE NOT short",
    "chunked_rows": chunk_sql.CHUNKED,
    "split_rows": chunk_sql.split_alone(800, 600),
    "split_words": chunk_sql.split_alone(60, 40),
    "near_duplicates": r"""WITH RECURSIVE k AS MATERIALIZED (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS i, dense_rank() OVER (ORDER BY coalesce(title, '')) AS l, dense_rank() OVER (ORDER BY lower(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g'))) AS r FROM documents WHERE text IS NOT NULL),
g(i, doc_id, verdict, ls, rs) AS (SELECT 0::BIGINT, NULL::BIGINT, NULL::VARCHAR, []::BIGINT[], []::BIGINT[]
UNION ALL SELECT k.i, k.doc_id, CASE WHEN list_contains(ls, l) THEN 'left' WHEN list_contains(rs, r) THEN 'right' ELSE 'accepted' END,
  CASE WHEN list_contains(ls, l) OR list_contains(rs, r) THEN ls ELSE list_append(ls, l) END, CASE WHEN list_contains(ls, l) OR list_contains(rs, r) THEN rs ELSE list_append(rs, r) END FROM g JOIN k ON k.i = g.i + 1)
SELECT doc_id, verdict FROM g WHERE i > 0""",
    "counts_by_document_and_type": "SELECT CASE grouping_id(doc_id, chunk_type) WHEN 1 THEN 'document' WHEN 2 THEN 'type' ELSE 'total' END AS level, coalesce(doc_id, chunk_type) AS name, count(*) AS n FROM chunks GROUP BY GROUPING SETS ((doc_id), (chunk_type), ())",
    "family_counts": "SELECT CASE WHEN grouping(f) = 1 THEN 'TOTAL' ELSE f END AS family, "
    + ", ".join(f"count_if(chunk_type = '{k}')::BIGINT AS {k}" for k in ("control", "control_enhancement", "control_discussion", "assessment_objective", "assessment_method"))
    + " FROM (SELECT upper(split_part(control_id, '-', 1)) AS f, chunk_type FROM chunks WHERE control_id IS NOT NULL) GROUP BY ROLLUP (f)",
    "length_stats": f"WITH c AS (SELECT chunk_type, length(text)::INT AS n, CASE WHEN chunk_type IN {schemas.STRUCTURED_TYPES} THEN 80 ELSE 200 END AS floor FROM chunks WHERE text IS NOT NULL) SELECT chunk_type, count(*) AS total, min(n) AS shortest, list_sort(list(n))[count(*) // 2 + 1] AS upper_median, max(n) AS longest, count_if(n < floor)::BIGINT AS under, count_if(n > 8000)::BIGINT AS over FROM c GROUP BY chunk_type",
    "text_bytes": "SELECT count(text) AS rows, sum(strlen(text))::BIGINT AS bytes FROM chunks",
    "expected_counts": """WITH v AS (
SELECT 'control_rows' AS "check", '' AS subject, count_if(chunk_type IN ('control', 'control_enhancement'))::BIGINT AS value, 900 AS low, 1200 AS high FROM chunks
UNION ALL SELECT 'families', '', count(DISTINCT split_part(control_id, '-', 1)) FILTER (chunk_type = 'control' AND control_id <> ''), 20, 20 FROM chunks
UNION ALL SELECT 'ssdf_practices', '', count_if(chunk_type = 'ssdf_practice')::BIGINT, 40, -1 FROM chunks
UNION ALL SELECT 'ai_rmf_subcategories', doc_id, count(DISTINCT split_part(id, ' (part ', 1)), 60, 80 FROM chunks WHERE chunk_type = 'ai_rmf_subcategory' GROUP BY doc_id)
SELECT *, value < low OR (high > 0 AND value > high) AS warning FROM v""",
    "control_list": r"""WITH d AS (SELECT DISTINCT control_id AS c, regexp_matches(control_id, '^[a-z]+-\d+(\.\d+)?$') AS ok FROM chunks WHERE control_id IS NOT NULL),
k AS (SELECT c, CASE WHEN ok THEN split_part(c, '-', 1) ELSE c END AS f, CASE WHEN ok THEN regexp_extract(c, '-(\d+)', 1)::INT ELSE 0 END AS n, CASE WHEN ok THEN coalesce(try_cast(nullif(regexp_extract(c, '\.(\d+)$', 1), '') AS INT), 0) ELSE 0 END AS e,
upper(split_part(c, '.', 1)) || CASE WHEN regexp_replace(c, '^[^.]*\.?', '') <> '' THEN '(' || regexp_replace(c, '^[^.]*\.?', '') || ')' ELSE '' END AS shown FROM d)
SELECT string_agg(shown, ', ' ORDER BY f, n, e, c) AS controls, count_if(NOT contains(c, '.'))::BIGINT AS base, count_if(contains(c, '.'))::BIGINT AS enhancements FROM k""",
    "export_order": r"""WITH c AS (SELECT row_no, doc_id, id, coalesce(control_id, '') AS c, coalesce(regexp_matches(control_id, '^[a-z]+-\d+(\.\d+)?$'), false) AS ok FROM chunks)
SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, CASE WHEN ok THEN split_part(c, '-', 1) ELSE c END, CASE WHEN ok THEN regexp_extract(c, '-(\d+)', 1)::INT ELSE 0 END, CASE WHEN ok THEN coalesce(try_cast(nullif(regexp_extract(c, '\.(\d+)$', 1), '') AS INT), 0) ELSE 0 END, id NULLS FIRST, row_no) AS place, row_no, doc_id, id FROM c""",
    "rejected_ids": "SELECT id, row_no IS NOT NULL AS found, row_no, chunk_type FROM (SELECT DISTINCT ref AS id FROM rejections WHERE ref IS NOT NULL) LEFT JOIN (SELECT id, row_no, chunk_type FROM chunks QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_no) = 1) USING (id)",
    "logged_rejections": "SELECT stage, rule, count(*) AS n FROM (SELECT DISTINCT doc_id, ref, rule, detail, stage, logged_at FROM rejections) GROUP BY stage, rule",
    "rows_without_manifest": "SELECT row_no, doc_id FROM chunks WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM manifest_docs WHERE doc_id IS NOT NULL)",
    "rows_of_retrieved": "SELECT row_no FROM chunks WHERE sha256_source IN (SELECT sha256 FROM provenance WHERE sha256 IS NOT NULL)",
}
