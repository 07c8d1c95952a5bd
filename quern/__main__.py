"""python -m quern STAGE: the stages of a build, from files to files.

    manifest   MANIFEST                        check a manifest; all problems, exit 1 if any
    verify     MANIFEST REPORT                 probe every address, write the report; exit 1 if any does not answer
    fetch      MANIFEST FOLDER                 fetch what is missing into FOLDER/raw (--include-web, --force)
    catalog    FILES MANIFEST PROVENANCE OUT   rows and rejections of catalogs (Parquet of file_id, doc_id, mini_catalog)
    lines      LINES MANIFEST PROVENANCE OUT   rows and rejections of laid-out documents (Parquet of lines)
    chunk      INTERIM OUT                     right-sized rows of the row files in INTERIM
    validate   CHUNKED MANIFEST PROVENANCE OUT valid rows, rejections and summary.md
    export     VALID OUT                       one sorted Parquet file
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import schemas
from quern.operators import catalog, chunking, ordered, publications, quality, rules
from quern.session import local_session, release
from quern.sources import artifacts, fetch, manifest, records, sinks


def _write(rows: DataFrame, rejections: DataFrame, out: str) -> None:
    sinks.write_jsonl(rows, f"{out}/rows")
    sinks.write_jsonl(rejections, f"{out}/rejections", schemas.REJECTION_FIELDS)


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of JSON lines, with seq in the order of documents and ids."""
    read = spark.read.schema(schemas.ROW).json(folder)
    return ordered.positions(read, [F.col("doc_id"), F.col("id"), F.xxhash64(*schemas.ROW_FIELDS)], "seq")


def main(arguments: list[str], spark: SparkSession | None = None, client: fetch.Client | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quern", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("stage", choices=("manifest", "verify", "fetch", "catalog", "lines", "chunk", "validate", "export"))
    parser.add_argument("paths", nargs="+")
    parser.add_argument("--include-web", action="store_true")
    parser.add_argument("--force", action="store_true")
    parser.add_argument("--sample", nargs="*", default=[], help="ids of rows to show")
    parser.add_argument("--assessment", default=None, help="document to which assessment rows belong")
    options = parser.parse_args(arguments)
    spark, paths = spark or local_session(), options.paths
    if options.stage == "manifest":
        try:
            print(manifest.read_manifest(spark, paths[0]).count(), "documents")
        except ValueError as error:
            print(error, file=sys.stderr)
            return 1
        return 0
    if options.stage == "verify":
        documents = manifest.read_manifest(spark, paths[0])
        checks = fetch.verify(spark, documents, client)
        Path(paths[1]).write_text(sinks.verification_report(documents, checks))
        dead = checks.where("url IS NOT NULL AND NOT coalesce(status BETWEEN 200 AND 299, false)").count()
        print(f"{dead} addresses do not answer")
        return int(dead > 0)
    if options.stage == "fetch":
        done = fetch.fetch_all(spark, manifest.read_manifest(spark, paths[0]), Path(paths[1]), client, options.include_web, options.force)
        for name, (action, detail) in done.items():
            print(f"{action:<15} {name} {detail}")
        return int(any(action == "failed" for action, _ in done.values()))
    done = _stage(options, spark, paths)
    release(spark)
    return done


def _stage(options: argparse.Namespace, spark: SparkSession, paths: list[str]) -> int:
    """The stages from rows to rows; their intermediate tables go when the result is written."""
    if options.stage in ("catalog", "lines"):
        source, documents, provenance, out = paths
        about, known = manifest.read_manifest(spark, documents), artifacts.read_provenance(spark, provenance)
        if options.stage == "catalog":
            rows, rejections, counts = catalog.parse_catalogs(spark.read.parquet(source), options.assessment)
            counts.groupBy("family").pivot("kind").sum("n").orderBy("family").show(1_000)
        else:
            rows, rejections = publications.parse_publications(spark.read.schema(schemas.LINE).parquet(source))
            rows = publications.identified(rows)
        full = records.with_document(rows, about, known)
        _write(full, rejections, out)
        if options.sample:
            asked = spark.createDataFrame([(x,) for x in options.sample], "id string")
            quality.by_ids(spark.read.schema(schemas.ROW).json(f"{out}/rows").withColumn("seq", F.lit(0)), asked).show(len(options.sample), False, True)
        return 0
    if options.stage == "chunk":
        read = records.read_interim(spark, paths[0])
        numbered = ordered.positions(read, [F.col("file_name"), F.col("line_no")], "seq")
        rows, rejections = chunking.chunk_rows(records.strict_rows(numbered, keep=("seq",)))
        _write(rows, rejections, paths[1])
        return 0
    if options.stage == "validate":
        chunked, documents, provenance, out = paths
        valid, rejections = rules.validate(_rows(spark, chunked), manifest.read_manifest(spark, documents), artifacts.read_provenance(spark, provenance))
        _write(valid, rejections, out)
        Path(out, "summary.md").write_text(quality.summary_markdown(valid, rejections, quality.expected_counts(valid)))
        return 0
    sinks.write_parquet(spark.read.schema(schemas.ROW).json(paths[0]), paths[1], files=1)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
