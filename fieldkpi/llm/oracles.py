"""DuckDB SQL for the queries that plain counting can check, for small tables.

These follow the contracts alone: all pairs of documents that share a shingle are
counted, and spans are running lengths of what the patterns split and match.
"""

from __future__ import annotations

from fieldkpi.llm.decontaminate import MIN_SCORE, MIN_SHARE, MIN_WORDS, SPAN
from fieldkpi.llm.secrets import BASE, EXAMPLE_OWNERS, KINDS


def near_duplicates_sql(table: str = "documents", width: int = 5, pct: int = 75) -> str:
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS w FROM {table}
),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {width} + 2), lambda i: array_to_string(w[i:i + {width - 1}], ' ')) END) AS s FROM w
),
post AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets),
inter AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM post a JOIN post b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2
),
link AS (SELECT a, b FROM inter WHERE 100 * c >= {pct} * (na + nb - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(x, y) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.x, e.b FROM reach r JOIN edge e ON e.a = r.y)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.m AS component_id, s.doc_id = r.m AS kept
FROM sets s JOIN (SELECT x, min(y) AS m FROM reach GROUP BY x) r ON r.x = s.doc_id"""


def secret_scan_sql(table: str = "documents") -> str:
    def found(k: int) -> str:
        name, pattern, group, least = KINDS[k]
        p = "'" + pattern.replace("'", "''") + "'"
        return (f"SELECT doc_id, source, {k} AS kind, '{name}' AS name, {least} AS least, string_split_regex(text, {p}) AS pieces, "
                f"regexp_extract_all(text, {p}, 0) AS whole, regexp_extract_all(text, {p}, {group}) AS val FROM d")

    counts = ", ".join(f"CAST(count(*) FILTER (WHERE name = '{n}') AS BIGINT) AS n_{n}" for n in BASE)
    base = ", ".join(f"'{n}'" for n in BASE)
    return f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM {table}),
f AS ({' UNION ALL '.join(found(k) for k in range(len(KINDS)))}),
m AS (
  SELECT doc_id, source, kind, name, least, unnest(list_transform(range(1, len(whole) + 1), lambda i: {{
    'start': list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0),
    'size': length(whole[i]), 'val': val[i]}})) AS m FROM f WHERE len(whole) > 0
),
c AS (
  SELECT doc_id, source, kind, name, CAST(m.start AS BIGINT) AS a, CAST(m.start + m.size AS BIGINT) AS z, m.val AS val FROM m
  WHERE length(m.val) >= least AND (name <> 'token' OR (regexp_matches(m.val, '[0-9]') AND regexp_matches(m.val, '[A-Z]') AND regexp_matches(m.val, '[a-z]')))
),
o AS (SELECT val, count(DISTINCT coalesce(source, chr(1))) < {EXAMPLE_OWNERS} AS live FROM c GROUP BY val),
s AS (SELECT c.*, live, name || ':' || a || ':' || z AS span FROM c JOIN o USING (val)),
g AS (
  SELECT doc_id, {counts},
    string_agg(span, ',' ORDER BY a, kind) FILTER (WHERE name IN ({base})) AS base,
    string_agg(span, ',' ORDER BY a, kind) FILTER (WHERE name IN ({base}) OR live) AS spans,
    CAST(count(*) FILTER (WHERE live) AS BIGINT) AS n_live, CAST(count(*) FILTER (WHERE NOT live) AS BIGINT) AS n_example
  FROM s GROUP BY doc_id
)
SELECT d.doc_id, {', '.join(f'coalesce(n_{n}, 0) AS n_{n}' for n in BASE)}, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
  coalesce(spans, '') AS spans, sha256(coalesce(base, '')) AS base_sha256
FROM d LEFT JOIN g USING (doc_id)"""


def contamination_sql(docs: str = "documents", items: str = "benchmark") -> str:
    """Every alignment with two equal words in a row is scored; a stretch that is
    accepted has some. A stretch's balance is the largest difference of two running
    sums along the alignment. Items shorter than the span are looked for whole."""
    pairs = "SELECT id, i, w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT id, w, unnest(range(0, len(w) - 1)) AS i FROM {0} WHERE len(w) >= {1})"
    return f"""
WITH d AS (SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM {docs}),
b AS (SELECT item_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM {items}),
ds AS ({pairs.format('d', 2)}),
bs AS ({pairs.format('b', SPAN)}),
hit AS (SELECT DISTINCT ds.id AS doc_id, bs.id AS item_id, ds.i - bs.i AS shift FROM ds JOIN bs ON ds.s = bs.s),
al AS (
  SELECT hit.*, len(b.w) AS n, list_transform(range(greatest(0, -shift), least(len(b.w), len(d.w) - shift)),
    lambda j: CASE WHEN d.w[j + shift + 1] = b.w[j + 1] THEN 1 ELSE -1 END) AS e
  FROM hit JOIN d ON d.id = hit.doc_id JOIN b ON b.id = hit.item_id
),
run AS (
  SELECT doc_id, item_id, shift, n, list_transform(range(0, len(e) + 1), lambda k: coalesce(list_sum(e[1:k]), 0)) AS p FROM al
  WHERE len(list_filter(e, lambda x: x = 1)) >= least({MIN_SCORE}, ceil(n * {MIN_SHARE}))
),
sc AS (
  SELECT doc_id, item_id, shift, n, CAST(list_max(list_transform(range(1, len(p) + 1), lambda k: p[k] - list_min(p[1:k]))) AS BIGINT) AS score FROM run
  UNION ALL
  SELECT d.id, b.id, d.i, len(b.w), len(b.w) FROM (SELECT id, w, unnest(range(0, len(w))) AS i FROM d) d JOIN (SELECT * FROM b WHERE len(w) BETWEEN 1 AND {SPAN - 1}) b
    ON d.w[d.i + 1:d.i + len(b.w)] = b.w AND (len(b.w) >= {MIN_WORDS} OR len(d.w) = len(b.w))
)
SELECT doc_id, item_id, max(score) AS score, CAST(any_value(n) AS BIGINT) AS n_words, CAST(arg_min(shift, shift - score * 1000000000) AS BIGINT) AS at
FROM sc WHERE score >= least({MIN_SCORE}, ceil(n * {MIN_SHARE})) GROUP BY doc_id, item_id"""


def suffix_dedup_sql(table: str = "documents", length: int = 400) -> str:
    """Every window of ``length`` bytes (as hex digits) is hashed and counted;
    the starts of repeated windows are joined to runs."""
    return f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM {table}),
z AS (SELECT doc_id, h, length(h) // 2 AS n FROM d),
win AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, {2 * length})) AS k FROM (SELECT doc_id, h, unnest(range(n - {length} + 1)) AS i FROM z WHERE n >= {length})),
many AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
hit AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS last FROM win SEMI JOIN many USING (k)),
run AS (SELECT doc_id, i, sum(CASE WHEN last IS NULL OR i > last + {length} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM hit),
span AS (SELECT doc_id, r, min(i) AS a, max(i) + {length} AS b FROM run GROUP BY doc_id, r),
gap AS (SELECT doc_id, a, b, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS nxt, row_number() OVER (PARTITION BY doc_id ORDER BY a) AS r FROM span),
left_ AS (
  SELECT z.doc_id, string_agg(CASE WHEN g.r = 1 THEN substr(h, 1, 2 * a) ELSE '' END || substr(h, 2 * b + 1, 2 * (coalesce(nxt, n) - b)), '' ORDER BY a) AS kept,
         CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans
  FROM gap g JOIN z ON z.doc_id = g.doc_id GROUP BY z.doc_id
)
SELECT z.doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM z LEFT JOIN left_ ON left_.doc_id = z.doc_id"""
