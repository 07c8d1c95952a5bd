"""Queries over nested catalogs (problem 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import nested


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/catalog_files.parquet")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.create_map(*[F.lit(x) for pair in nested.OSCAL_KINDS.items() for x in pair])
    found = nested.catalog_nodes(_files(spark, sf_dir))
    return found.select("file_id", kind[F.col("kind")].alias("node_kind"), F.col("path").alias("node_path"), F.col("parent").alias("parent_path"), "node_id")


def _table(field: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return nested.catalog_table(_files(spark, sf_dir), field)

    query.__name__ = f"p5_{field}"
    return query


def p5_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of all flat tables, properties too, with what its parent is, found by the surrogate keys alone."""
    fields = list(nested.OSCAL_COLUMNS)
    rows = nested.nodes(_files(spark, sf_dir), "file_id", "mini_catalog", "catalog", fields, {"name": ("name",)})
    parents = rows.select(F.col("node_key").alias("parent_key"), F.col("kind").alias("parent_kind"), F.col("node_id").alias("parent_id"), F.col("name").alias("parent_name"))
    return rows.join(parents, "parent_key", "left").select("file_id", "kind", "path", "ordinal", "node_id", "name", "parent_kind", "parent_id", "parent_name")


def p5_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all child tables that the merged schema asks for: of every field that holds objects in arrays somewhere."""
    rows = nested.nodes(_files(spark, sf_dir), "file_id", "mini_catalog", "catalog")
    return rows.select("file_id", "kind", "path", "parent", "ordinal", "node_id")


def p5_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged schema of all catalogs."""
    return nested.infer_schema(_files(spark, sf_dir), "mini_catalog", "catalog")


QUERIES = {f.__name__: f for f in (p5_found, *(_table(f) for f in nested.OSCAL_COLUMNS), p5_linked, p5_inferred, p5_schema)}

_TREE = """
WITH RECURSIVE f AS (SELECT file_id, CASE WHEN json_valid(mini_catalog) THEN mini_catalog::JSON END AS j FROM catalog_files),
n(file_id, kind, path, parent, ordinal, j) AS (
  SELECT file_id, '', '', '', 0, j->'catalog' FROM f WHERE json_type(j->'catalog') = 'OBJECT'
  UNION ALL
  SELECT file_id, name, CASE WHEN path = '' THEN '' ELSE path || '.' END || name || '.' || i, path, i, child FROM (
    SELECT n.file_id, n.path, s.name, i, CASE json_type(n.j->s.name) WHEN 'ARRAY' THEN (n.j->s.name)->i ELSE n.j->s.name END AS child
    FROM n, (VALUES ('groups'), ('controls'), ('params'), ('parts')) AS s(name),
         unnest(range(CASE json_type(n.j->s.name) WHEN 'ARRAY' THEN json_array_length(n.j->s.name)::INT WHEN 'OBJECT' THEN 1 ELSE 0 END)) AS u(i)
  ) WHERE json_type(child) = 'OBJECT'
)
"""
ORACLES = {"p5_found": _TREE + "SELECT file_id, rtrim(kind, 's') AS node_kind, path AS node_path, parent AS parent_path, coalesce(j->>'id', '') AS node_id FROM n WHERE kind <> ''"}

_ALL = _TREE.replace("('parts'))", "('parts'), ('props'))")
ORACLES["p5_linked"] = _ALL + "SELECT n.file_id, n.kind, n.path, n.ordinal::INT AS ordinal, coalesce(n.j->>'id', '') AS node_id, n.j->>'name' AS name, p.kind AS parent_kind, coalesce(p.j->>'id', CASE WHEN p.kind IS NULL THEN NULL ELSE '' END) AS parent_id, p.j->>'name' AS parent_name FROM n LEFT JOIN n p ON n.parent <> '' AND p.file_id = n.file_id AND p.path = n.parent AND p.kind <> '' WHERE n.kind <> ''"
#: Fields of all nodes with their types and the depth of the deepest, as the merged schema has them.
ORACLES["p5_schema"] = r"""WITH RECURSIVE f AS (SELECT CASE WHEN json_valid(mini_catalog) THEN mini_catalog::JSON END AS j FROM catalog_files),
n(kind, depth, j) AS (SELECT 'catalog', 0, j->'catalog' FROM f WHERE json_type(j->'catalog') = 'OBJECT'
  UNION ALL SELECT field, depth + 1, c FROM (SELECT n.depth, k AS field, unnest(CASE json_type(n.j->k) WHEN 'ARRAY' THEN (n.j->k)::JSON[] ELSE [n.j->k] END) AS c FROM n, unnest(json_keys(n.j)) AS u(k)) WHERE json_type(c) = 'OBJECT')
SELECT kind, field, CASE json_type(j->field) WHEN 'OBJECT' THEN 'object' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'DOUBLE' THEN 'double' WHEN 'ARRAY' THEN CASE WHEN list_contains(list_transform((j->field)::JSON[], lambda x: json_type(x)), 'OBJECT') THEN 'array<object>' ELSE 'array' END ELSE 'bigint' END AS type, max(depth)::INT AS depth
FROM n, unnest(json_keys(j)) AS u(field) GROUP BY ALL"""


def _flat(field: str) -> str:
    """One flat table of all catalogs, with surrogate keys made as the operator makes them."""
    key = "('0x' || substr(md5(concat_ws('/', file_id, {0})), 1, 15))::BIGINT"
    values = []
    for name, (first, *rest) in nested.OSCAL_COLUMNS[field].items():
        at = f"j->'{first}'" + "".join(f"->'{step}'" for step in rest)
        values.append(f"CASE json_type({at}) WHEN 'VARCHAR' THEN ({at})->>'$' WHEN 'NULL' THEN NULL ELSE ({at})::VARCHAR END AS \"{name}\"")
    return _ALL + f"SELECT file_id, path, parent, ordinal::INT AS ordinal, {key.format('path')} AS node_key, CASE WHEN parent <> '' THEN {key.format('parent')} END AS parent_key, coalesce(j->>'id', '') AS node_id, {', '.join(values)} FROM n WHERE kind = '{field}'"


ORACLES |= {f"p5_{field}": _flat(field) for field in nested.OSCAL_COLUMNS}

#: o: all objects; a: the fields that hold objects in arrays somewhere; n: what is reached over those alone.
ORACLES["p5_inferred"] = r"""WITH RECURSIVE f AS (SELECT file_id, CASE WHEN json_valid(mini_catalog) THEN mini_catalog::JSON END AS j FROM catalog_files),
o(j) AS (SELECT j->'catalog' FROM f WHERE json_type(j->'catalog') = 'OBJECT'
  UNION ALL SELECT c FROM (SELECT unnest(CASE json_type(o.j->k) WHEN 'ARRAY' THEN (o.j->k)::JSON[] ELSE [o.j->k] END) AS c FROM o, unnest(json_keys(o.j)) AS u(k)) WHERE json_type(c) = 'OBJECT'),
a AS (SELECT DISTINCT k FROM o, unnest(json_keys(j)) AS u(k) WHERE CASE json_type(j->k) WHEN 'ARRAY' THEN list_contains(list_transform((j->k)::JSON[], lambda x: json_type(x)), 'OBJECT') ELSE false END),
n(file_id, kind, path, parent, ordinal, j) AS (SELECT file_id, '', '', '', 0, j->'catalog' FROM f WHERE json_type(j->'catalog') = 'OBJECT'
  UNION ALL SELECT file_id, k, CASE WHEN path = '' THEN '' ELSE path || '.' END || k || '.' || i, path, i, child FROM (
    SELECT n.file_id, n.path, a.k, i, CASE json_type(n.j->a.k) WHEN 'ARRAY' THEN (n.j->a.k)->i ELSE n.j->a.k END AS child
    FROM n, a, unnest(range(CASE json_type(n.j->a.k) WHEN 'ARRAY' THEN json_array_length(n.j->a.k)::INT WHEN 'OBJECT' THEN 1 ELSE 0 END)) AS u(i)) WHERE json_type(child) = 'OBJECT')
SELECT file_id, kind, path, parent, ordinal::INT AS ordinal, coalesce(j->>'id', '') AS node_id FROM n WHERE kind <> ''"""
