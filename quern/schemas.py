"""Explicit schemas and fixed vocabularies; nothing is ever inferred from a build's data."""

from __future__ import annotations

from pyspark.sql import types as T


_ROW_FIELDS = "id text doc_id doc_title revision pub_date tier chunk_type control_id section_path source_url sha256_source".split()
#: The published row: one chunk. control_id and section_path may be null.
ROW = T.StructType([T.StructField(n, T.IntegerType() if n == "tier" else T.StringType(), n in ("control_id", "section_path")) for n in _ROW_FIELDS])
ROW_FIELDS = tuple(_ROW_FIELDS)
REQUIRED = tuple(n for n in _ROW_FIELDS if n not in ("control_id", "section_path"))
#: What was left out, and why.
REJECTION = T.StructType([T.StructField(n, T.StringType()) for n in "doc_id ref rule detail stage".split()])
REJECTION_FIELDS = tuple(REJECTION.fieldNames())
#: One rendered line of a laid-out document.
LINE = T.StructType(
    [T.StructField("doc_id", T.StringType(), False), T.StructField("line_no", T.LongType(), False), T.StructField("text", T.StringType()), T.StructField("page", T.IntegerType()), T.StructField("size", T.DoubleType()), T.StructField("bold", T.BooleanType()), T.StructField("y", T.DoubleType())]
)
DOCUMENT_FIELDS = ("doc_id", "title", "revision", "pub_date", "tier", "format", "url", "landing_page", "status", "license", "notes")
DOCUMENT = T.StructType([T.StructField(n, T.IntegerType() if n == "tier" else T.StringType()) for n in DOCUMENT_FIELDS])
PROVENANCE_ENTRY = T.StructType(
    [T.StructField("sha256", T.StringType()), T.StructField("bytes", T.LongType()), T.StructField("retrieved_at", T.StringType()), T.StructField("url", T.StringType()), T.StructField("http_status", T.IntegerType()), T.StructField("source", T.StringType()), T.StructField("skipped", T.BooleanType()), T.StructField("note", T.StringType())]
)

# Vocabularies and limits that results depend on.
CHUNK_TYPES = ("control", "control_enhancement", "control_discussion", "assessment_objective", "assessment_method", "baseline", "section", "task", "ai_rmf_subcategory", "ssdf_practice", "definition", "table")
STRUCTURED_TYPES = ("control", "control_enhancement", "control_discussion", "assessment_objective", "assessment_method", "baseline", "ai_rmf_subcategory", "ssdf_practice", "definition")
CONTROL_FAMILIES = ("ac", "at", "au", "ca", "cm", "cp", "ia", "ir", "ma", "mp", "pe", "pl", "pm", "ps", "pt", "ra", "sa", "sc", "si", "sr")
FORMATS = ("oscal", "pdf", "embedded-in-oscal", "pdf-manual", "web")
CONTROL_FORMATS = ("oscal", "embedded-in-oscal")
MAX_TEXT = 8000
MIN_TEXT = 200
MIN_TEXT_STRUCTURED = 80
TARGET_PART = 6000
