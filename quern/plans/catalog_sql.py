"""Control catalogs restated in SQL: a recursive walk over the JSON trees, then joins of nodes, to check `catalogs`."""

from __future__ import annotations

from quern.plans.text import normal_sql

_MARK = r"\{\{\s*insert:\s*param,\s*[^}\s]+\s*\}\}"
_MARK_ID = r"\{\{\s*insert:\s*param,\s*([^}\s]+)\s*\}\}"
_OPEN = "[Assignment: organization-defined parameter]"

#: n: every node with its kind, path, parent and order (params before parts before controls, by place).
TREE = r"""WITH RECURSIVE f AS (SELECT file_id, CASE WHEN json_valid(mini_catalog) THEN mini_catalog::JSON END AS j FROM catalog_files),
n(file_id, kind, path, parent, ordinal, ord, j) AS (
  SELECT file_id, '', '', '', 0, '', j->'catalog' FROM f WHERE json_type(j->'catalog') = 'OBJECT'
  UNION ALL
  SELECT file_id, name, CASE WHEN path = '' THEN '' ELSE path || '.' END || name || '.' || i, path, i, CASE WHEN path = '' THEN '' ELSE ord || '.' END || code || '.' || lpad(i::VARCHAR, 10, '0'), child FROM (
    SELECT n.file_id, n.path, n.ord, s.name, s.code, i, CASE json_type(n.j->s.name) WHEN 'ARRAY' THEN (n.j->s.name)->i ELSE n.j->s.name END AS child
    FROM n, (VALUES ('groups', '0'), ('params', '1'), ('parts', '2'), ('controls', '3')) AS s(name, code),
         unnest(range(CASE json_type(n.j->s.name) WHEN 'ARRAY' THEN json_array_length(n.j->s.name)::INT WHEN 'OBJECT' THEN 1 ELSE 0 END)) AS u(i)
  ) WHERE json_type(child) = 'OBJECT'
),
a AS (SELECT *, coalesce(j->>'id', '') AS id, j->>'title' AS title, CASE json_type(j->'props') WHEN 'ARRAY' THEN (j->'props')::JSON[] WHEN 'OBJECT' THEN [j->'props'] ELSE []::JSON[] END AS props FROM n WHERE kind <> '')"""


def _resolved(name: str, source: str, keys: str, text: str, index: str) -> str:
    """CTE `name`: `source` with the markers in `text` replaced once by what `index` (file_id, param_id, rendered) has."""
    return rf"""{name}_x AS (SELECT {keys}, {text}, regexp_split_to_array({text}, '{_MARK}') AS bits, list_append(list_transform(regexp_extract_all({text}, '{_MARK_ID}', 1), lambda x: rtrim(x, ',')), NULL) AS ids FROM {source}),
{name}_y AS (SELECT {keys}, k, bits[k] AS bit, ids[k] AS mark FROM {name}_x, unnest(range(1, len(bits) + 1)) AS u(k)),
{name} AS (SELECT {", ".join("y." + k.strip() for k in keys.split(","))}, string_agg(bit || CASE WHEN y.mark IS NULL THEN '' ELSE coalesce(x.rendered, '{_OPEN}') END, '' ORDER BY k) AS {text}, count_if(y.mark IS NOT NULL AND x.rendered IS NULL) AS missing FROM {name}_y y LEFT JOIN {index} x ON x.file_id = y.file_id AND x.param_id = y.mark GROUP BY ALL)"""


#: p4: every parameter as printed, after four rounds of resolving.
PARAMS = (
    TREE
    + """,
p0 AS (SELECT file_id, id AS param_id, max_by(CASE WHEN coalesce(json_type(j->'select'), 'NULL') <> 'NULL'
    THEN '[Selection' || coalesce('; ' || nullif(replace(j->'select'->>'how-many', '-', ' '), ''), '') || ': ' || CASE json_type(j->'select'->'choice') WHEN 'ARRAY' THEN array_to_string(list_transform((j->'select'->'choice')::JSON[], lambda c: c->>'$'), '; ') ELSE '' END || ']'
    ELSE '[Assignment: organization-defined ' || coalesce(nullif(j->>'label', ''), id) || ']' END, ord) AS rendered FROM a WHERE kind = 'params' AND id <> '' GROUP BY ALL),
"""
    + ",\n".join(_resolved(f"p{k}", f"p{k - 1}", "file_id, param_id", "rendered", "p0") for k in range(1, 5))
)

#: t: parts with their prose resolved, the control and the section they are in, and their line.
LINES = (
    PARAMS
    + rf""",
t0 AS (SELECT file_id, path, coalesce(j->>'prose', '') AS prose FROM a WHERE kind = 'parts'),
{_resolved("t1", "t0", "file_id, path", "prose", "p4")},
t2 AS (SELECT a.file_id, a.path, a.parent, a.ord, a.j->>'name' AS name, props, regexp_replace(t1.prose, '{_MARK}', '{_OPEN}', 'g') AS prose, t1.missing,
  regexp_extract(a.path, '^((?:.*\.)?controls\.\d+)\.parts\.', 1) AS control, regexp_extract(a.path, '^((?:.*\.)?controls\.\d+\.parts\.\d+)', 1) AS top FROM a JOIN t1 USING (file_id, path) WHERE a.kind = 'parts'),
t3 AS (SELECT t.*, h.name AS section, h.ord AS top_ord, coalesce(list_filter(h.props, lambda p: p->>'name' = 'method')[1]->>'value', 'METHOD') AS method, t.path = t.top AS own,
  EXISTS (SELECT 1 FROM t2 c WHERE c.file_id = t.file_id AND c.parent = t.path) AS inner_parts FROM t2 t JOIN t2 h ON h.file_id = t.file_id AND h.path = t.top WHERE t.control <> ''),
t4 AS (SELECT *, CASE WHEN own OR section = 'assessment-method' AND parent = top THEN '' ELSE coalesce(list_filter(props, lambda p: p->>'name' = 'label' AND coalesce(p->>'class', '') = '')[1]->>'value', list_filter(props, lambda p: p->>'name' = 'label' AND p->>'class' = 'sp800-53a')[1]->>'value', '') END AS label FROM t3),
t AS (SELECT *, nullif(trim(CASE WHEN prose <> '' OR label <> '' AND NOT inner_parts THEN CASE WHEN label <> '' THEN label || ' ' ELSE '' END || prose END), '') AS shown, rtrim(CASE WHEN label <> '' THEN label || ' ' ELSE '' END || prose) AS line FROM t4),
bodies AS (
  SELECT file_id, control AS path, 1 AS kind_order, '' AS top, coalesce(string_agg(line, chr(10) ORDER BY ord) FILTER (shown IS NOT NULL), '') AS body FROM t WHERE section = 'statement' GROUP BY ALL
  UNION ALL SELECT file_id, control, 2, top, coalesce(string_agg(line, chr(10) ORDER BY ord) FILTER (shown IS NOT NULL), '') FROM t WHERE section = 'guidance' GROUP BY ALL
  UNION ALL SELECT file_id, control, 3, '', coalesce(string_agg(line, chr(10) ORDER BY ord) FILTER (shown IS NOT NULL), '') FROM t WHERE section = 'assessment-objective' GROUP BY ALL
  UNION ALL SELECT file_id, control, 4, '', string_agg(block, chr(10) || chr(10) ORDER BY top_ord) FROM (
    SELECT file_id, control, top, top_ord, array_to_string(list_transform(regexp_extract_all(lower(method), '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), '') || ': ' || trim(string_agg(line, chr(10) ORDER BY ord) FILTER (shown IS NOT NULL)) AS block
    FROM t WHERE section = 'assessment-method' AND NOT own GROUP BY file_id, control, top, top_ord, method) WHERE block IS NOT NULL GROUP BY ALL)"""
)


def _shown(x: str) -> str:
    return f"upper(split_part({x}, '.', 1)) || CASE WHEN regexp_replace({x}, '^[^.]*\\.?', '') <> '' THEN '(' || regexp_replace({x}, '^[^.]*\\.?', '') || ')' ELSE '' END"


#: c: controls with what their rows are headed by; rows: a row for each body of a live control.
ROWS = (
    LINES
    + rf""",
w AS (SELECT file_id, path, parent, ord, id, coalesce(title, '') AS title, len(list_filter(props, lambda p: p->>'name' = 'status' AND p->>'value' = 'withdrawn')) > 0 AS withdrawn, regexp_extract(path, '^((?:.*\.)?groups\.\d+)\.', 1) AS home FROM a WHERE kind = 'controls'),
c0 AS (SELECT w.*, u.id AS parent_id, u.title AS parent_title, coalesce(nullif(g.id, ''), '') AS family, CASE WHEN g.path IS NULL THEN '' ELSE coalesce(g.title, upper(g.id)) END AS family_title, d.doc_id
  FROM w LEFT JOIN w u ON u.file_id = w.file_id AND u.path = w.parent LEFT JOIN a g ON g.file_id = w.file_id AND g.path = w.home AND g.kind = 'groups' JOIN catalog_files d ON d.file_id = w.file_id),
c AS (SELECT *, {_shown('id')} AS printed, {_shown('parent_id')} AS above, 'Family: ' || family_title || ' (' || upper(family) || ')' AS context FROM c0),
live AS (SELECT *, upper(family) || CASE WHEN parent_id IS NULL THEN '' ELSE ' > ' || above END || ' > ' || printed AS base, CASE WHEN parent_id IS NULL THEN context ELSE context || ' > ' || above || ' ' || parent_title END AS place FROM c WHERE NOT withdrawn AND id <> ''),
dull AS (SELECT *, kind_order = 2 AND lower(regexp_replace(trim(body), '\.+$', '')) IN ('none', '') AS dull FROM bodies),
rows0 AS (SELECT l.file_id, l.ord AS "order", d.kind_order, l.family, CASE d.kind_order WHEN 1 THEN CASE WHEN parent_id IS NULL THEN 'control' ELSE 'control_enhancement' END WHEN 2 THEN 'control_discussion' WHEN 3 THEN 'assessment_objective' ELSE 'assessment_method' END AS chunk_type, l.id AS control_id,
  CASE WHEN d.kind_order < 3 THEN l.doc_id ELSE 'assessment' END AS doc_id, base || CASE d.kind_order WHEN 1 THEN '' WHEN 2 THEN ' > Discussion' WHEN 3 THEN ' > Assessment Objective' ELSE ' > Assessment Methods' END AS section_path,
  CASE d.kind_order WHEN 1 THEN CASE WHEN parent_id IS NULL THEN printed || ' ' || title ELSE printed || ' ' || parent_title || ' | ' || title END || chr(10) || place WHEN 2 THEN printed || ' ' || title || ' - Discussion' || chr(10) || place
    WHEN 3 THEN printed || ' ' || title || ' - Assessment Objective' || chr(10) || 'Determine if the following are satisfied:' ELSE printed || ' ' || title || ' - Assessment Methods and Objects' END || chr(10) || chr(10) || body AS raw
  FROM live l JOIN dull d USING (file_id, path) WHERE trim(body) <> '' AND NOT dull)"""
)

ORACLES = {
    "catalog_rows": ROWS
    + f""" SELECT file_id, "order", kind_order, chunk_type, control_id, doc_id, section_path, {normal_sql('raw')} AS text, concat_ws('/', doc_id, chunk_type, trim(regexp_replace(lower(control_id), '[^a-z0-9.]+', '-', 'g'), '-')) AS id FROM rows0""",
    "catalog_rejections": ROWS
    + """ SELECT doc_id, rule, count(*) AS n FROM (SELECT doc_id, 'withdrawn_control' AS rule FROM c WHERE withdrawn UNION ALL SELECT doc_id, 'no_id' FROM c WHERE NOT withdrawn AND id = ''
UNION ALL SELECT doc_id, 'no_statement' FROM live WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.file_id = live.file_id AND t.control = live.path AND section = 'statement')
UNION ALL SELECT doc_id, 'empty_discussion' FROM live JOIN dull USING (file_id, path) WHERE dull) GROUP BY ALL""",
    "catalog_counts": ROWS + " SELECT file_id, family, kind, count(*) AS n FROM (SELECT file_id, family, chunk_type AS kind FROM rows0 UNION ALL SELECT file_id, family, 'withdrawn' FROM c WHERE withdrawn) GROUP BY ALL",
    "catalog_params": PARAMS + " SELECT file_id, param_id, rendered FROM p4",
    "catalog_unresolved": LINES.split(",\nt2 AS")[0]
    + " SELECT y.mark AS param_id, count(*) AS n FROM t1_y y LEFT JOIN p4 ON p4.file_id = y.file_id AND p4.param_id = y.mark WHERE y.mark IS NOT NULL AND p4.rendered IS NULL GROUP BY ALL",
    "baseline_rows": r"""WITH i AS (SELECT DISTINCT doc_id, control_id AS c, regexp_matches(control_id, '^[a-z]+-\d+(\.\d+)?$') AS ok FROM chunks WHERE control_id IS NOT NULL AND doc_id IS NOT NULL),
k AS (SELECT *, CASE WHEN ok THEN split_part(c, '-', 1) ELSE c END AS f, CASE WHEN ok THEN regexp_extract(c, '-(\d+)', 1)::INT ELSE 0 END AS n, CASE WHEN ok THEN coalesce(try_cast(nullif(regexp_extract(c, '\.(\d+)$', 1), '') AS INT), 0) ELSE 0 END AS e,
  upper(split_part(c, '.', 1)) || CASE WHEN regexp_replace(c, '^[^.]*\.?', '') <> '' THEN '(' || regexp_replace(c, '^[^.]*\.?', '') || ')' ELSE '' END AS shown, regexp_extract(doc_id, '([^-]*)$', 1) AS name FROM i)
SELECT doc_id || '/baseline/' || trim(regexp_replace(lower(name), '[^a-z0-9.]+', '-', 'g'), '-') AS id,
  'SP 800-53B ' || name || ' baseline. Untitled. The ' || name || ' baseline selects ' || count(*) || ' controls and control enhancements (' || count_if(NOT contains(c, '.')) || ' base controls, ' || count_if(contains(c, '.')) || ' enhancements) from the SP 800-53 Rev 5 catalog. Selected control identifiers:' || chr(10) || chr(10) || string_agg(shown, ', ' ORDER BY f, n, e, c) AS text,
  doc_id, 'baseline' AS chunk_type, 'SP 800-53B Baselines > ' || name AS section_path FROM k GROUP BY doc_id, name""",
}
