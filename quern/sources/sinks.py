"""Where rows and rejections go."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern import schemas
from quern.operators import quality


def write_jsonl(df: DataFrame, path: str, fields: tuple[str, ...] = schemas.ROW_FIELDS) -> None:
    """One JSON object a line, in UTF-8, with nulls kept."""
    df.select(*fields).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_parquet(rows: DataFrame, path: str, files: int | None = None) -> None:
    """Rows of the published schema in published order, compressed by snappy.

    Required columns are asserted to hold no null, as the format on disk forgets it. `files` asks for so many files,
    1 for a small build; by default the sort's own partitions are written.
    """
    checked = [F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is null")).cast(schemas.ROW[c].dataType)).otherwise(F.col(c)).alias(c) if c in schemas.REQUIRED else F.col(c).cast(schemas.ROW[c].dataType).alias(c) for c in schemas.ROW_FIELDS]
    ordered = quality.export_order(rows.select(*checked))
    (ordered.coalesce(files) if files else ordered).write.mode("overwrite").option("compression", "snappy").parquet(path)


def provenance_json(provenance: DataFrame) -> str:
    """The provenance file: an object keyed by document, sorted. It has a line for each publication of the manifest."""
    entries = provenance.orderBy("doc_id").collect()
    return json.dumps({r["doc_id"]: {f: r[f] for f in schemas.PROVENANCE_ENTRY.fieldNames()} for r in entries}, indent=2) + "\n"


def verification_report(manifest: DataFrame, checks: DataFrame) -> str:
    """Markdown about every publication: whether its address answers, what its landing page says, what people must do.

    `checks` is what `fetch.verify` gives. One row for each publication comes to the driver.
    """
    about = checks.select("doc_id", *[c for c in ("status", "method", "note", "resolved_url", "signals") if c in checks.columns])
    rows = [r.asDict() for r in manifest.select("doc_id", "title", "format", "revision", "url", "landing_page").join(about, "doc_id", "left").orderBy("doc_id").collect()]
    answers = lambda r: r.get("status") is not None and 200 <= r["status"] < 300
    lines = ["# Verification report", "", f"Publications: **{len(rows)}**", "", "| doc_id | title | format | HTTP | note |", "|---|---|---|---:|---|"]
    for r in rows:
        note = " -> ".join(x for x in (r.get("note") or "", r.get("resolved_url") or "") if x)
        lines.append(f"| `{r['doc_id']}` | {r['title']} | {r['format']} | {'-' if r.get('status') is None else r['status']} | {note} |")
    checked = [r for r in rows if r.get("signals")]
    lines += ["", "## Standing", "", *([f"- `{r['doc_id']}` ({r['revision'] or 'no revision'}): {r['signals']}" for r in checked] or ["- nothing to check"])]
    dead = [r for r in rows if r["url"] and not answers(r)]
    lines += ["", "## Verdict", "", *([f"- `{r['doc_id']}` does not answer: {r['url']}" for r in dead] or ["Every address answers."])]
    manual = [r for r in rows if r["format"] == "pdf-manual"]
    lines += [f"- `{r['doc_id']}` is placed by hand, from {r['landing_page']}" for r in manual]
    return "\n".join(lines) + "\n"
