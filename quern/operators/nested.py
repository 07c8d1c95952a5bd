"""Deeply nested records as flat tables that keep parent and child linked.

The merged schema of all records is inferred first, in one distributed pass: for every kind of node, which fields it has
and of which types, and how deep the nesting goes. Fields that hold objects in arrays somewhere become child tables,
also where one object stands alone instead of in an array. Then every level is opened below the one before it, all
in one stage without a shuffle, as VARIANT values in the JVM. A row carries its parent's key and its place in the array.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import stored

#: Child tables when none are named: the plan has a step for each, so records that use data as field names are refused.
MAX_FIELDS = 20_000


def _kind_of(value: object) -> str:
    if isinstance(value, list):
        return "array<object>" if any(isinstance(x, dict) for x in value) else "array"
    names = {dict: "object", str: "string", bool: "boolean", int: "bigint", float: "double", type(None): "null"}
    return names[type(value)]


def _walk(node: dict, kind: str, depth: int, seen: dict[tuple[str, str, str], int]) -> None:
    """Adds what a node and all below it have: (kind, field, type) -> greatest depth. The kind of a child is its field."""
    stack = [(node, kind, depth)]
    while stack:
        node, kind, depth = stack.pop()
        for field, value in node.items():
            key = (kind, field, _kind_of(value))
            seen[key] = max(seen.get(key, 0), depth)
            for child in value if isinstance(value, list) else [value]:
                if isinstance(child, dict):
                    stack.append((child, field, depth + 1))


def infer_schema(records: DataFrame, column: str, root: str) -> DataFrame:
    """kind, field, type, depth: the merged schema of the objects under `root`, over all readable records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str, str], int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                try:
                    record = json.loads(text)
                except (ValueError, RecursionError):
                    continue
                top = record.get(root) if isinstance(record, dict) else None
                if isinstance(top, dict):
                    _walk(top, root, 0, seen)
        rows = [(*key, depth) for key, depth in seen.items()]
        columns = list(zip(*rows)) if rows else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int32()))], names=["kind", "field", "type", "depth"])

    found = records.where(F.col(column).isNotNull()).select(column).mapInArrow(run, "kind string, field string, type string, depth int")
    return found.groupBy("kind", "field", "type").agg(F.max("depth").alias("depth"))


def _literal(name: str) -> str:
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


_OBJECT = "map<string, variant>"


def _attributes(node: str, columns: dict[str, tuple[str, ...]]) -> str:
    """SQL for the wanted values of a node (a map of its fields), as a struct of strings."""
    values = []
    for name, (first, *rest) in columns.items():
        value = f"{node}[{_literal(first)}]"
        for step in rest:
            value = f"try_cast({value} AS {_OBJECT})[{_literal(step)}]"
        values.append(f"try_cast({value} AS string) AS `{name}`")
    return f"struct({', '.join(values)})"


def _children(name: str, columns: dict[str, tuple[str, ...]], passed: dict[str, tuple[str, str]]) -> str:
    """SQL for the objects in field `name` of the node `n`, as an array of structs; one alone has ordinal 0."""
    label, at = _literal(name), f"n.m[{_literal(name)}]"
    many = f"transform(try_cast({at} AS array<variant>), x -> try_cast(x AS {_OBJECT}))"
    alone = f"array(try_cast({at} AS {_OBJECT}))"
    more = "".join(f" {sql.replace('{field}', label)} AS `{given}`," for given, (_, sql) in passed.items())
    return (
        f"filter(transform(CASE WHEN {at} IS NULL THEN array() ELSE coalesce({many}, {alone}) END, (x, i) -> struct({label} AS kind, concat_ws('.', nullif(n.path, ''), {label}, i) AS path, n.path AS parent, int(i) AS ordinal,"
        f" {_attributes('x', columns)} AS values,{more} x AS m)), c -> c.m IS NOT NULL)"
    )


def tree_arrays(records: DataFrame, keep: list[str], column: str, root: str, fields: list[str], depth: int, columns: dict[str, tuple[str, ...]], passed: dict[str, tuple[str, str]] | None = None) -> tuple[DataFrame, Column]:
    """(the columns `keep` of every readable record with its levels, the array of its nodes): all objects below `root`
    reached over `fields`, as structs of kind (the field), path, parent, ordinal, values, level by level.

    Within the row of a record each level is one array, made from the level before. So a record is read once and every
    node is handled once, whatever the depth; a node is opened as a map of its fields. passed: further values of a node
    by name, as SQL for the root's and SQL for a child's, which may use those of its parent `n`, the place `i` and
    `{field}`, the field it is in: so what stands above a node comes down to it without a join.
    """
    passed = passed or {}
    top = f"try_cast(try_cast(try_parse_json({column}) AS {_OBJECT})[{_literal(root)}] AS {_OBJECT})"
    rows = records.where(F.col(column).isNotNull()).select(*keep, F.expr(top).alias("_m")).where("_m IS NOT NULL")
    begin = "".join(f" {sql} AS `{given}`," for given, (sql, _) in passed.items())
    rows = rows.select(*keep, F.expr(f"array(struct('' AS kind, '' AS path, {_attributes('_m', columns)} AS values,{begin} _m AS m))").alias("_0"))
    for level in range(depth):
        below = f"flatten(transform(_{level}, n -> concat({', '.join(_children(f, columns, passed) for f in fields)})))"
        rows = rows.select("*", F.expr(below).alias(f"_{level + 1}"))
    more = "".join(f", n.`{given}`" for given in passed)
    levels = [F.expr(f"transform(_{k}, n -> struct(n.kind, n.path, n.parent, n.ordinal, n.values{more}))") for k in range(1, depth + 1)]
    nothing = "".join(f", {sql} AS `{given}`" for given, (sql, _) in passed.items())
    none = F.expr(f"filter(array(struct('' AS kind, '' AS path, '' AS parent, 0 AS ordinal, {_attributes(f'CAST(NULL AS {_OBJECT})', columns)} AS values{nothing})), n -> false)")
    return rows, F.concat(none, *levels)


def depth_of(schema: DataFrame, fields: list[str] | None = None) -> int:
    """How many levels of the wanted fields there may be; depth counts objects of all fields, so it is that at least."""
    nested = schema.where(F.col("type").isin("object", "array<object>"))
    return 1 + (nested if fields is None else nested.where(F.col("field").isin(*fields))).agg(F.coalesce(F.max("depth"), F.lit(-1))).first()[0]


def _surrogate(key: str, path: str) -> Column:
    """A number that any engine can compute again from the key of the record and the path."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", F.col(key).cast("string"), path)), 1, 15), 16, 10).cast("bigint")


def nodes(records: DataFrame, key: str, column: str, root: str, fields: list[str] | None = None, columns: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Every object in the nested arrays of JSON texts, linked to its parent.

    Returns key, kind (the field it is in), path (fields and positions from the root, joined by dots), parent (the path
    of the enclosing node, empty at the top), ordinal (its position in the array, from 0), node_key and parent_key
    (surrogate keys: 60 bits of a digest of key and path), node_id (its id as written, empty if it has none), and the values named in
    `columns` (name -> names of the fields that lead to it) as strings. `fields` restricts the search to fields of these names; by
    default all that hold arrays of objects somewhere.
    Null, empty and unreadable texts, and such without an object under `root`, have no nodes; nulls and plain values in
    the arrays are no nodes but keep their positions; empty arrays have none. Records with the same key or the same
    text each give their nodes. Other columns are ignored. A null key stays null.
    """
    schema = infer_schema(records, column, root)
    listed = fields
    if listed is None:
        schema = stored(schema, "schema")
        found = schema.where("type = 'array<object>'").select("field").distinct().limit(MAX_FIELDS + 1).collect()
        if len(found) > MAX_FIELDS:
            raise ValueError(f"more than {MAX_FIELDS} fields hold arrays of objects; the records use data as field names")
        listed = sorted(r["field"] for r in found)
    depth = depth_of(schema, listed) if listed else 0
    rows, found = tree_arrays(records, [key], column, root, listed, depth, {"node_id": ("id",)} | (columns or {}))
    flat = rows.select(key, F.explode(found).alias("n")).select(key, "n.kind", "n.path", "n.parent", "n.ordinal", "n.values")
    return flat.select(
        key, "kind", "path", "parent", "ordinal",
        _surrogate(key, "path").alias("node_key"), F.when(F.col("parent") != "", _surrogate(key, "parent")).alias("parent_key"),
        F.coalesce("values.node_id", F.lit("")).alias("node_id"), *[f"values.{name}" for name in columns or {}],
    )


#: Kinds of OSCAL nodes by the field that holds them, and the columns of their tables (fixed values).
OSCAL_KINDS = {"groups": "group", "controls": "control", "params": "param", "parts": "part"}
OSCAL_COLUMNS: dict[str, dict[str, tuple[str, ...]]] = {
    "groups": {"class": ("class",), "title": ("title",)},
    "controls": {"class": ("class",), "title": ("title",)},
    "params": {"label": ("label",), "how_many": ("select", "how-many"), "choice": ("select", "choice")},
    "parts": {"name": ("name",), "prose": ("prose",)},
    "props": {"name": ("name",), "value": ("value",), "class": ("class",)},
}


def catalog_nodes(files: DataFrame) -> DataFrame:
    """Groups, controls, params and parts of every readable catalog; see `nodes`."""
    return nodes(files, "file_id", "mini_catalog", "catalog", list(OSCAL_KINDS))


def catalog_table(files: DataFrame, field: str) -> DataFrame:
    """One flat table of all catalogs: groups, controls, params, parts or props."""
    fields = [*OSCAL_KINDS, *({field} - set(OSCAL_KINDS))]
    return nodes(files, "file_id", "mini_catalog", "catalog", fields, OSCAL_COLUMNS[field]).where(F.col("kind") == field).drop("kind")
