"""DuckDB SQL for the queries that SQL can express, each in its own formulation."""

from __future__ import annotations

from marketbars.llm import decontamination as dc
from marketbars.llm import linechunks as lc
from marketbars.llm import superkmers as sk

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
LETTERS = r"list_filter(regexp_split_to_array(lower(text), '[^\pL\pN]+'), lambda x: x <> '')"

SUBSTRING = f"""
WITH split AS (SELECT doc_id, {WORDS} AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + {sk.WINDOW - 1}], ' ') AS body
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {sk.WINDOW - 2})) AS i
        FROM split WHERE len(ws) >= {sk.WINDOW})),
late AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY body) AS first FROM windows)
  WHERE doc_id > first),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {sk.WINDOW})) AS j FROM late),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM split),
kept AS (
  SELECT doc_id, count(gone.j) AS n_removed,
    string_agg(word, ' ' ORDER BY j) FILTER (gone.j IS NULL) AS body
  FROM words LEFT JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, coalesce(len(ws), 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(body, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""

_weights = " + ".join(
    f"{lc.BASE**i} * coalesce(lag(h, {i}) OVER (PARTITION BY doc_id ORDER BY i), 0)"
    if i
    else "h"
    for i in range(lc.ROLL)
)
LINES = rf"""
WITH numbered AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    unnest(range(0, len(string_split(text, chr(10))))) AS i
  FROM documents WHERE text IS NOT NULL),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM numbered),
rolled AS (SELECT *, ({_weights}) % {lc.JOIN} <> 0 AS ends FROM hashed),
parted AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM rolled),
chunks AS (
  SELECT doc_id, chunk, min(i) AS start, string_agg(line, chr(10) ORDER BY i) AS body
  FROM parted GROUP BY doc_id, chunk),
placed AS (
  SELECT doc_id, start,
    first_value(doc_id) OVER (PARTITION BY body ORDER BY doc_id, start) AS of_doc,
    first_value(start) OVER (PARTITION BY body ORDER BY doc_id, start) AS of_start
  FROM chunks WHERE regexp_matches(body, '[^\x20\x09-\x0D]')),
late AS (
  SELECT doc_id, start, of_doc, start - of_start AS shift FROM placed
  WHERE doc_id <> of_doc OR start <> of_start),
beside AS (
  SELECT d.doc_id, p.of_doc, p.shift, d.i,
    d.i - row_number() OVER (PARTITION BY d.doc_id, p.of_doc, p.shift ORDER BY d.i) AS run
  FROM (SELECT DISTINCT doc_id, of_doc, shift FROM late) p
  JOIN numbered d ON d.doc_id = p.doc_id
  JOIN numbered o ON o.doc_id = p.of_doc AND o.i = d.i - p.shift AND o.line = d.line),
runs AS (
  SELECT doc_id, of_doc, shift, run, min(i) AS low, max(i) AS high FROM beside
  GROUP BY doc_id, of_doc, shift, run HAVING count(*) >= {lc.LEAST_LINES}),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(low, high + 1)) AS i
  FROM (SELECT DISTINCT r.doc_id, low, high FROM runs r JOIN late l
    ON r.doc_id = l.doc_id AND r.of_doc = l.of_doc AND r.shift = l.shift
      AND l.start BETWEEN low AND high) a),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(gone.i) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (gone.i IS NULL), '') AS body
  FROM numbered LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  sha256(body) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""


def _masked(mask: str) -> str:
    looked = [f"ws[i + {k + 1}]" for k, bit in enumerate(mask) if bit == "1"]
    return f"CASE WHEN i + {len(mask)} <= len(ws) THEN concat_ws(' ', '{mask}', {', '.join(looked)}) END"


def _seeded(name: str, split: str, key: str) -> str:
    columns = ", ".join(_masked(mask) for mask in dc.MASKS)
    return f"""{name} AS (
  SELECT * FROM (
    SELECT {key}, i, unnest([{columns}]) AS seed
    FROM (SELECT {key}, ws, unnest(range(0, len(ws))) AS i FROM {split}))
  WHERE seed IS NOT NULL)"""


LEAKS = f"""
WITH docs AS (SELECT doc_id, {LETTERS} AS ws FROM documents),
items AS (
  SELECT item_id, ws FROM (SELECT item_id, {LETTERS} AS ws FROM benchmark)
  WHERE len(ws) >= {dc.LEAST_WORDS}),
{_seeded("doc_seeds", "docs", "doc_id")},
{_seeded("item_seeds", "items", "item_id")},
diagonals AS (
  SELECT doc_id, item_id, d.i - q.i AS shift, min(d.i) AS first, max(d.i) AS last, count(*) AS hits
  FROM doc_seeds d JOIN item_seeds q USING (seed) GROUP BY ALL),
laid AS (
  SELECT g.*, least({dc.STRETCH}, len(items.ws)) AS width,
    list_transform(
      range(greatest(0, -shift), least(len(items.ws), len(docs.ws) - shift)),
      lambda k: CASE WHEN docs.ws[k + shift + 1] = items.ws[k + 1] THEN 1 ELSE 0 END) AS equal
  FROM diagonals g JOIN docs USING (doc_id) JOIN items USING (item_id)),
scored AS (
  SELECT *, list_max(list_transform(range(1, len(equal) - width + 2),
    lambda s: list_sum(equal[s:s + width - 1])))::BIGINT AS n_equal
  FROM laid)
SELECT doc_id, item_id, min(first)::INT AS first_word,
  (max(last) + {min(map(len, dc.MASKS)) - 1})::INT AS last_word, max(n_equal) AS n_equal,
  sum(hits)::BIGINT AS n_hits
FROM scored WHERE n_equal >= ceil(width * {dc.SHARE}) GROUP BY doc_id, item_id
"""

URLS = r"""
WITH rules (host, path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
places AS (SELECT DISTINCT host, path FROM parts),
best AS (
  SELECT * FROM (
    SELECT p.host, p.path, r.host || r.path AS rule, r.verdict,
      row_number() OVER (PARTITION BY p.host, p.path
        ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
    FROM places p JOIN rules r
      ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
  WHERE place = 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (host, path)
"""

ORACLE = {
    "op2_decontamination": LEAKS,
    "op7_substring_dedup": SUBSTRING,
    "op8_line_dedup": LINES,
    "op13_url_filters": URLS,
}
