"""Queries of control catalogs, over catalog_files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import catalog
from quern.plans import catalog_sql


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/catalog_files.parquet")


def catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of every catalog, in the order of the trees."""
    return catalog.parse_catalogs(_files(spark, sf_dir))[0]


def catalog_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.parse_catalogs(_files(spark, sf_dir))[1].groupBy("doc_id", "rule").agg(F.count("*").alias("n"))


def catalog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.parse_catalogs(_files(spark, sf_dir))[2]


def catalog_part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.part_names(_files(spark, sf_dir))


def catalog_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every parameter as it is printed."""
    return catalog.param_index(_files(spark, sf_dir))


#: Every prose begins with markers: of parameters that some catalogs have, and of one that none has.
_MARKED = ('"prose":\\s*"', '"prose": "Follow {{ insert: param, none-1 }}, {{insert: param, pl-1_odp.01 }} and {{ insert: param, ac-1_odp.01, }} here: ')


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _files(spark, sf_dir).withColumn("mini_catalog", F.regexp_replace("mini_catalog", _MARKED[0], _MARKED[1]))


def catalog_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all catalogs when every prose holds markers."""
    return catalog.parse_catalogs(_marked(spark, sf_dir))[0]


def catalog_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The markers of those that no parameter of their catalog resolves."""
    return catalog.unresolved_params(_marked(spark, sf_dir))


def baseline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile for each document of the chunks, of the controls that its rows name."""
    chunks = spark.read.parquet(f"{sf_dir}/chunks.parquet").where("control_id IS NOT NULL AND doc_id IS NOT NULL")
    ids = chunks.groupBy("doc_id").agg(F.array_sort(F.collect_set("control_id")).alias("ids"))
    profile = F.to_json(F.struct(F.struct(F.array(F.struct(F.array(F.struct(F.col("ids").alias("with-ids"))).alias("include-controls"))).alias("imports")).alias("profile")))
    return catalog.parse_profiles(ids.select("doc_id", F.lit("Untitled").alias("doc_title"), profile.alias("profile")))


QUERIES = {f.__name__: f for f in (catalog_rows, catalog_rejections, catalog_counts, catalog_part_names, catalog_params, catalog_marked, catalog_unresolved, baseline_rows)}
ORACLES = catalog_sql.ORACLES | {"catalog_part_names": catalog_sql.TREE + "SELECT j->>'name' AS name, count(*) AS n FROM a WHERE kind = 'parts' AND regexp_matches(path, '(?:^|\\.)controls\\.\\d+\\.parts\\.') GROUP BY 1"}
_MARKED_FILES = "FROM (SELECT file_id, regexp_replace(mini_catalog, '{}', '{}', 'g') AS mini_catalog FROM catalog_files)),".format(_MARKED[0], _MARKED[1])
ORACLES["catalog_marked"] = ORACLES["catalog_rows"].replace("FROM catalog_files),", _MARKED_FILES, 1)
ORACLES["catalog_unresolved"] = ORACLES["catalog_unresolved"].replace("FROM catalog_files),", _MARKED_FILES, 1)
