"""SQL for the operators that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _vector_codes(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    steps = [f"""
kept AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label,
           [CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS c
         FROM embeddings WHERE embedding IS NOT NULL
           AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
x AS MATERIALIZED (
  SELECT r, vec_id, label, p, j, c[p * (len(c) // {parts}) + j + 1] AS v
  FROM (SELECT *, unnest(range(len(c) // {parts})) AS j
        FROM (SELECT *, unnest(range({parts})) AS p FROM kept))),
b0 AS (SELECT p, r AS e, j, CAST(v AS HUGEINT) AS c FROM x WHERE r < {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, p, min(d * {entries} + e) % {entries} AS e, min(d * {entries} + e) // {entries} AS d
  FROM (SELECT x.r, x.p, b.e, sum((x.v - b.c) * (x.v - b.c)) AS d
        FROM x JOIN b{i} b ON x.p = b.p AND x.j = b.j GROUP BY ALL) GROUP BY ALL)""")
        if i < rounds:
            steps.append(f"""
b{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.j,
    CASE WHEN n > 0 THEN (s - ((s % n + n) % n)) // n ELSE b.c END AS c
  FROM b{i} b LEFT JOIN (
    SELECT x.p, a.e, x.j, sum(x.v) AS s, count(*) AS n
    FROM x JOIN a{i} a ON x.r = a.r AND x.p = a.p GROUP BY ALL) m
  ON b.p = m.p AND b.e = m.e AND b.j = m.j)""")
    return f"""WITH {','.join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code,
            CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) AS digest
          FROM b{rounds})
SELECT vec_id, code, error,
  CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  digest AS codebooks_sha256
FROM kept JOIN coded USING (r), books"""


_SHARED_LINES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, i, lines[i] AS line,
        translate(trim(lines[i], {_BLANKS}), '{_UPPER}', '{_LOWER}') AS key
      FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM d)),
gone AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
m AS (SELECT l.*, gone.key IS NOT NULL AS dropped FROM l LEFT JOIN gone ON l.key = gone.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), ''))
    AS kept_sha256
FROM m JOIN d USING (r) GROUP BY r"""

_DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang,
             coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, translate(unnest(regexp_extract_all(text,
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), '{_UPPER}', '{_LOWER}') AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term)
      GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS MATERIALIZED (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    CAST(1 + (1000000000 * (CAST(coalesce(c.n, 0) AS HUGEINT) + 1))
      // (coalesce(gn.total, 0) + v) AS BIGINT) AS p
  FROM g JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN gn USING (lang, source)
    LEFT JOIN c USING (lang, source, term)),
ln AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
q AS (SELECT lang, term, CAST(1 + (1000000000 * (CAST(n AS HUGEINT) + 1))
        // (sum(n) OVER (PARTITION BY lang) + v) AS BIGINT) AS q
      FROM ln JOIN sizes USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
          GROUP BY ALL),
rows_ AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item,
    CAST(coalesce(pairs.value, 0) AS BIGINT) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
    LEFT JOIN pairs ON pairs.lang = x.lang AND pairs.source = x.source AND pairs.item = y.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, (p - q) * (p - q) // q
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)
  AS INTEGER) AS rank FROM rows_ QUALIFY part = 'pair' OR rank <= 200"""

_ARCHIVES = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
n AS (SELECT *, strlen(h) AS payload_bytes,
        max(page_id) OVER (PARTITION BY h) AS last_id FROM p),
r AS (SELECT *, payload_bytes >= 1000 AND page_id < last_id AS again FROM n)
SELECT page_id, payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN last_id END AS refers_to FROM r"""

ORACLE = {
    "op9_warc": _ARCHIVES,
    "op11_vector_codes": _vector_codes(),
    "op12_shared_lines": _SHARED_LINES,
    "op13_source_divergence": _DIVERGENCE,
}
