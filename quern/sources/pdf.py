"""PDF files as the relation of lines, where a PDF library is installed.

    files = pdf.read_files(spark, folder)
    lines = pdf.lines_of(pdf.spans(files))
    grids = pdf.grids(files)

Executors read the files, from any file system that Spark can. Python only hands out what the library finds, spans and
tables; what makes a line of spans is a plan like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as T

try:
    import pymupdf
except ImportError:
    pymupdf = None

#: The bit of a span's flags that says it is bold (fixed value).
BOLD = 1 << 4


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id (the file's name without its ending) and content of every PDF file of a folder and those below it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)\.pdf\z", 1).alias("doc_id"), "content")


def _each(files: DataFrame, schema: str, found: Callable[[str, object], Iterator[dict]]) -> DataFrame:
    """What `found` gives for each opened file; a file is read by one task, and its rows leave page by page."""
    if pymupdf is None:
        raise ImportError("reading PDF files needs pymupdf")
    arrow = pa.schema(files.sparkSession.createDataFrame([], schema).toArrow().schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with pymupdf.open(stream=content, filetype="pdf") as document:
                    for rows in found(doc_id, document):
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return files.select("doc_id", "content").mapInArrow(run, schema)


SPANS = "doc_id string, page int, line_no bigint, y double, spans array<struct<text:string,size:double,flags:int>>"


def spans(files: DataFrame) -> DataFrame:
    """The lines of every page as the library finds them, with their spans."""

    def found(doc_id: str, document) -> Iterator[list[dict]]:
        number = 0
        for page, content in enumerate(document, start=1):
            rows = []
            for block in content.get_text("dict")["blocks"]:
                for raw in block.get("lines", []):
                    own = [{"text": s["text"], "size": float(s["size"]), "flags": int(s["flags"])} for s in raw["spans"]]
                    rows.append({"doc_id": doc_id, "page": page, "line_no": number, "y": float(raw["bbox"][1]), "spans": own})
                    number += 1
            yield rows

    return _each(files, SPANS, found)


def lines_of(found: DataFrame) -> DataFrame:
    """doc_id, line_no, text, page, size, bold, y of lines given as spans; lines of nothing but space are none.

    Size and weight are those of the longest span that shows, of equal ones the first, so that a stray footnote mark does
    not make or break a heading.
    """
    visible = F.filter("spans", lambda s: T.strip(s["text"]) != "")
    longest = F.array_min(F.transform(visible, lambda s, i: F.struct((-F.length(s["text"])).alias("n"), i.alias("i"), s["size"].alias("size"), s["flags"].alias("flags"))))
    text = T.strip(F.array_join(F.transform("spans", lambda s: s["text"]), ""))
    shown = found.select("doc_id", "line_no", text.alias("text"), "page", longest.alias("main"), F.bround("y", 1).alias("y")).where("main IS NOT NULL")
    return shown.select("doc_id", "line_no", "text", "page", F.bround("main.size", 1).alias("size"), (F.col("main.flags").bitwiseAND(BOLD) != 0).alias("bold"), "y")


def grids(files: DataFrame) -> DataFrame:
    """doc_id, page, grid: of the tables of each page that with the most rows."""

    def found(doc_id: str, document) -> Iterator[list[dict]]:
        for page, content in enumerate(document, start=1):
            tables = [t.extract() for t in content.find_tables().tables]
            yield [{"doc_id": doc_id, "page": page, "grid": max(tables, key=len)}] if tables else []

    return _each(files, "doc_id string, page int, grid array<array<string>>", found)
