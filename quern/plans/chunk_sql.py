"""The chunking stage restated in SQL, step by step over rows instead of expressions, to check the queries of `build`."""

from __future__ import annotations

from quern import schemas
from quern.plans.text import normal_sql

HEADER = r"(?i)^(?:APPENDIX|CHAPTER)\s+[A-Za-z0-9-]{1,10}\s+(?:PAGE\s+[A-Za-z0-9-]{1,10}\s+)?"
TAG = r"^\[[A-Z0-9][A-Za-z0-9 .\-]{0,40}\]\s*"
REFERENCE = rf"CASE WHEN regexp_matches(u, '{TAG}') THEN regexp_matches(substr(regexp_replace(u, '{TAG}', ''), 1, 300), '(?i)(available at|https?://|\(\d{{4}}\)|\bU\.S\. Code\b|\bed\.\b|\bpp\.\s*\d|\bvol\.\s*\d)') ELSE regexp_matches(u, '^[A-Z][A-Za-z''’\-]+,\s+[A-Z]\.(\s*[A-Z]\.)*[,\s]+(\(\d{{4}}\)|[\"“])') END"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


#: Islands of short sections and the row that follows each, over r(row_no, doc_id, id, chunk_type, text).
ISLANDS = """s AS (SELECT *, coalesce(chunk_type = 'section' AND length(text) < 200, false) AS short FROM r),
i AS (SELECT *, sum(CASE WHEN short THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY row_no) - CASE WHEN short THEN 0 ELSE 1 END AS island FROM s),
o AS (SELECT doc_id, island, row_no AS at, coalesce(chunk_type = 'section', false) AS fits FROM i WHERE NOT short),
g AS (SELECT i.doc_id, o.at, string_agg(text, chr(10) || chr(10) ORDER BY row_no) AS stubs FROM i JOIN o ON o.doc_id IS NOT DISTINCT FROM i.doc_id AND o.island = i.island WHERE short AND fits GROUP BY ALL)"""
MERGED = f"CASE WHEN stubs IS NULL THEN text ELSE {normal_sql('(stubs || chr(10) || chr(10) || text)')} END"

#: Rows normalised and without leading furniture.
CLEANED = rf"""n AS (SELECT row_no, doc_id, id, chunk_type, section_path, {normal_sql('text')} AS t, CASE WHEN chunk_type IN {schemas.STRUCTURED_TYPES} THEN 80 ELSE 200 END AS floor FROM chunks),
c AS (SELECT *, regexp_replace(regexp_replace(t, '{HEADER}', ''), '^\s+', '') AS h FROM n),
e AS (SELECT *, CASE WHEN length(h) >= floor THEN h ELSE t END AS u FROM c),
f AS (SELECT *, regexp_matches(u, '{TAG}') AND NOT ({REFERENCE}) AS tagged, regexp_replace(regexp_replace(u, '{TAG}', ''), '^\s+', '') AS v FROM e),
k AS (SELECT *, CASE WHEN tagged AND length(v) >= floor THEN v ELSE u END AS w, {strip(rf"regexp_replace(regexp_replace(regexp_replace(section_path, '{HEADER}', ''), '^\s+', ''), '^[> ]+', '')")} AS p FROM f),
r AS (SELECT row_no, doc_id, id, chunk_type, CASE WHEN w <> t AND p <> '' THEN p ELSE section_path END AS section_path, w AS text FROM k)"""


def split(source: str, most: int, target: int) -> str:
    """CTEs that cut the texts of `source` (row_no, text) over `most`: parts(row_no, l), the list of each text's parts.

    Units are sentences or pieces of too long ones, packed within paragraphs; paragraphs are packed into parts that
    start with the last paragraph of the part before; short parts are folded.
    """
    return rf"""big AS (SELECT row_no, text FROM {source} WHERE length(text) > {most}),
para AS (SELECT row_no, j, l[j] AS p FROM (SELECT row_no, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: {strip('x')}), lambda x: x <> '') AS l FROM big), unnest(range(1, len(l) + 1)) AS x(j)),
sent AS (SELECT row_no, j, q, l[q] AS rest FROM (SELECT row_no, j, string_split(regexp_replace(p, '([.;:])\s+', '\1' || chr(1), 'g'), chr(1)) AS l FROM para WHERE length(p) > {target}), unnest(range(1, len(l) + 1)) AS x(q)),
cuts(row_no, j, q, z, piece, rest, alone) AS (
  SELECT row_no, j, q, 0, NULL::VARCHAR, rest, false FROM sent
  UNION ALL
  SELECT row_no, j, q, z + 1, {strip("left(rest, n)")}, CASE WHEN n >= length(rest) THEN '' ELSE regexp_replace(substr(rest, n + 1), '^\s+', '') END, length(rest) > {target} AND n < length(rest) FROM (
    SELECT *, CASE WHEN length(rest) <= {target} THEN length(rest) WHEN contains(substr(rest, 2, {target} - 1), ' ') THEN {target} - strpos(reverse(left(rest, {target})), ' ') ELSE {target} END AS n FROM cuts WHERE rest <> '')),
unit AS (SELECT row_no, j, row_number() OVER (PARTITION BY row_no, j ORDER BY q, z) AS y, piece, alone FROM cuts WHERE piece IS NOT NULL),
pack(row_no, j, y, done, now) AS (
  SELECT DISTINCT row_no, j, 0::BIGINT, []::VARCHAR[], '' FROM unit
  UNION ALL
  SELECT k.row_no, k.j, u.y,
    CASE WHEN u.alone THEN list_append(CASE WHEN now = '' THEN done ELSE list_append(done, now) END, piece) WHEN now = '' OR length(now) + 1 + length(piece) <= {target} THEN done ELSE list_append(done, now) END,
    CASE WHEN u.alone THEN '' WHEN now = '' THEN piece WHEN length(now) + 1 + length(piece) <= {target} THEN now || ' ' || piece ELSE piece END
  FROM pack k JOIN unit u ON u.row_no = k.row_no AND u.j = k.j AND u.y = k.y + 1),
whole AS (SELECT row_no, j, CASE WHEN now = '' THEN done ELSE list_append(done, now) END AS l FROM pack QUALIFY row_number() OVER (PARTITION BY row_no, j ORDER BY y DESC) = 1),
listed AS (SELECT row_no, j, l FROM whole UNION ALL SELECT row_no, j, [p] FROM para WHERE length(p) <= {target}),
block AS (SELECT row_no, row_number() OVER (PARTITION BY row_no ORDER BY j, a) AS b, l[a] AS t FROM listed, unnest(range(1, len(l) + 1)) AS x(a)),
fill(row_no, b, done, now, len) AS (
  SELECT DISTINCT row_no, 0::BIGINT, []::VARCHAR[], []::VARCHAR[], 0::BIGINT FROM block
  UNION ALL
  SELECT row_no, b, CASE WHEN over THEN list_append(done, array_to_string(now, chr(10) || chr(10))) ELSE done END,
    CASE WHEN NOT over THEN list_append(now, t) WHEN again THEN [now[-1], t] ELSE [t] END,
    CASE WHEN NOT over THEN len + length(t) + CASE WHEN len(now) > 0 THEN 2 ELSE 0 END WHEN again THEN length(now[-1]) + 2 + length(t) ELSE length(t) END
  FROM (SELECT f.row_no, k.b, k.t, done, now, len, len(now) > 0 AND len + length(t) + 2 > {target} AS over, coalesce(length(now[-1]) < {target // 2} AND length(now[-1]) + 2 + length(t) <= {most}, false) AS again FROM fill f JOIN block k ON k.row_no = f.row_no AND k.b = f.b + 1)),
filled AS (SELECT row_no, list_append(done, array_to_string(now, chr(10) || chr(10))) AS l FROM fill WHERE b > 0 QUALIFY row_number() OVER (PARTITION BY row_no ORDER BY b DESC) = 1),
fold(row_no, a, l, done) AS (
  SELECT row_no, 0, l, []::VARCHAR[] FROM filled
  UNION ALL
  SELECT row_no, a + 1, l, CASE WHEN len(done) > 0 AND length(l[a + 1]) < {target // 8} THEN list_append(done[:-2], done[-1] || chr(10) || chr(10) || l[a + 1]) ELSE list_append(done, l[a + 1]) END FROM fold WHERE a < len(l)),
parts AS (SELECT row_no, CASE WHEN len(done) > 1 AND length(done[1]) < {target // 8} THEN list_prepend(done[1] || chr(10) || chr(10) || done[2], done[3:]) ELSE done END AS l FROM fold WHERE a = len(l))"""


def numbered(source: str) -> str:
    """The rows of `source` with their texts cut, as the stage gives them."""
    return f"""SELECT m.row_no, CASE WHEN several THEN id || ' (part ' || a || ')' ELSE id END AS id, CASE WHEN several THEN a ELSE 0 END::INT AS part, chunk_type,
  CASE WHEN several THEN nullif(section_path, '') || ' (part ' || a || ')' ELSE section_path END AS section_path, length(CASE WHEN several THEN l[a] ELSE text END)::INT AS chars, sha256(CASE WHEN several THEN l[a] ELSE text END) AS sha256
FROM (SELECT m.*, p.l, coalesce(len(p.l) > 1, false) AS several FROM {source} m LEFT JOIN parts p USING (row_no)) m, unnest(range(1, CASE WHEN several THEN len(l) ELSE 1 END + 1)) AS x(a)"""


CHUNKED = f"WITH RECURSIVE {CLEANED},\n{ISLANDS},\nm AS (SELECT row_no, id, chunk_type, section_path, {MERGED} AS text FROM i LEFT JOIN g ON g.doc_id IS NOT DISTINCT FROM i.doc_id AND g.at = row_no WHERE NOT short),\n{split('m', schemas.MAX_TEXT, schemas.TARGET_PART)}\n{numbered('m')}"


def split_alone(most: int, target: int) -> str:
    return f"WITH RECURSIVE {split('chunks', most, target)}\n{numbered('chunks')}"
