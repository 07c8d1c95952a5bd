"""The manifest: which publications there are. Every problem of every entry is reported, not only the first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import schemas

TOP_LEVEL = ("manifest_version", "dataset_name", "maintainer", "documents")


def problems(documents: DataFrame) -> DataFrame:
    """doc_id, problem: one row for every rule that a document breaks.

    Rows with a column `fields` (the names that were present) are also checked for missing ones.
    """
    format_, tier = F.col("format"), F.col("tier")

    def url_problem(name: str):
        return F.when(F.col(name).isNotNull() & ~F.col(name).startswith("https://"), F.concat(F.lit(f"{name} must be https or null, got "), F.col(name)))

    checks = [
        F.when(~F.coalesce(format_.isin(*schemas.FORMATS), F.lit(False)), F.concat(F.lit("format "), F.coalesce(format_, F.lit("null")), F.lit(" is unknown"))),
        F.when(~F.coalesce(tier.isin(1, 2), F.lit(False)), F.concat(F.lit("tier must be 1 or 2, got "), F.coalesce(tier.cast("string"), F.lit("null")))),
        url_problem("url"), url_problem("landing_page"),
        F.when(format_.isin("oscal", "pdf", "web") & (F.coalesce("url", F.lit("")) == ""), F.concat(F.lit("format "), format_, F.lit(" requires a url"))),
        F.when((format_ == "pdf-manual") & (F.coalesce("landing_page", F.lit("")) == ""), F.lit("format pdf-manual requires a landing_page")),
    ]
    missing = F.array().cast("array<string>")
    if "fields" in documents.columns:
        absent = F.array_except(F.array(*[F.lit(f) for f in schemas.DOCUMENT_FIELDS]), F.col("fields"))
        missing = F.transform(absent, lambda f: F.concat(F.lit("missing field "), f))
    own = documents.select("doc_id", F.explode(F.concat(missing, F.array_compact(F.array(*checks)))).alias("problem"))
    twice = documents.groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit("duplicate doc_id").alias("problem"))
    return own.unionByName(twice)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a manifest file; raises with all problems if there are any. The file is one small JSON object."""
    text = spark.read.text(path, wholetext=True).withColumn("keys", F.json_object_keys("value"))
    top = text.select(F.array_except(F.array(*[F.lit(k) for k in TOP_LEVEL]), F.coalesce("keys", F.array().cast("array<string>"))).alias("missing")).first()
    found = [f"top level: missing {name}" for name in top["missing"]]
    entries = text.select(F.explode(F.from_json(F.get_json_object("value", "$.documents"), "array<string>")).alias("entry"))
    documents = entries.select(F.from_json("entry", schemas.DOCUMENT).alias("d"), F.json_object_keys("entry").alias("fields")).select("d.*", "fields")
    if documents.isEmpty():
        found.append("top level: documents must be a non-empty list")
    found += [f"{r['doc_id']}: {r['problem']}" for r in problems(documents).orderBy("doc_id", "problem").collect()]
    if found:
        raise ValueError("manifest failed validation:\n  - " + "\n  - ".join(found))
    return documents.drop("fields")
