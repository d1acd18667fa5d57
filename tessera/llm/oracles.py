"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

# Words of a text: A-Z lower-cased, then digits, letters and what lies beyond ASCII.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), named AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM parts
), split AS (
  SELECT page_id,
         translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
  FROM named
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
)
SELECT page_id, host, path,
       (SELECT max_by(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
       coalesce((SELECT max_by(rule_verdict, length(rule_host || rule_path)) FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)), 'allow') AS verdict
FROM split
"""

OP2 = """
WITH whole AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP4 = rf"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM docs), sizes
  WHERE i + n - 1 <= len(w)
),
found AS (SELECT doc_id, i, n, item_id FROM grams JOIN windows USING (n, gram)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM found GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP6 = """
WITH sums AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), last AS (
  SELECT payload, max(page_id) AS last_id FROM sums GROUP BY payload
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       array_to_string(
         [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 (((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (5 * (3 - i % 4))::BIGINT) & 31) + 1)::BIGINT, 1)
          FOR i IN generate_series(0, 31)], '') AS payload_digest,
       CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last_id THEN last_id END AS refers_to
FROM sums JOIN last USING (payload)
"""

# Words between ASCII white space.
_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_CRC32 = """xor(4294967295, list_reduce(
           list_concat([4294967295], [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
           lambda acc, c: list_reduce([xor(acc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""

# Streaks of matches on every diagonal, from pairs of equal grams of six words.
OP11 = rf"""
WITH plain AS (SELECT doc_id, {_SPACED} AS w, {_CRC32} AS h FROM documents),
cut AS (SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a FROM plain),
timed AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM cut),
docs AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
         THEN [w[(CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1)::BIGINT] FOR i IN generate_series(0, n - 1)] ELSE w END AS w
  FROM timed
),
grams AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(w[i - 5 : i], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(generate_series(6, n)) AS i FROM docs WHERE n >= 12)
),
pairs AS (SELECT x.doc_id, x.i, x.i - y.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i > y.i),
streaks AS (
  SELECT doc_id, q, min(i) - 5 AS first, max(i) AS last
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island
),
runs AS MATERIALIZED (
  SELECT doc_id, (first - q - 1)::BIGINT AS start, (last - first + 1 + q)::BIGINT AS length, q::BIGINT AS period
  FROM streaks WHERE last - first + 1 >= greatest(q, 12 - q)
  QUALIFY row_number() OVER (PARTITION BY doc_id, first - q, last ORDER BY q) = 1
),
listed AS (
  SELECT doc_id, count(*) AS n_runs, arg_max([start, length, period], [length, -start, -period]) AS best,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id
),
dropped AS (
  SELECT DISTINCT doc_id, unnest(generate_series(start + period + 1, start + length)) AS i FROM runs
),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS rest
  FROM (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, n)) AS i FROM docs) ANTI JOIN dropped USING (doc_id, i)
  GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best[1] AS start, best[2] AS length, best[3] AS period,
       (1000 * best[2]) // best[3] AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _lloyd(rounds: int) -> str:
    """The rounds of product codebooks, one after the other."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
  SELECT r, p, any_value(part) AS part, arg_min(e, [d, e]) AS e, min(d) AS d
  FROM (SELECT r, p, e, part, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(part, entry)])::BIGINT AS d
        FROM parts JOIN book{r} USING (p))
  GROUP BY r, p
)""")
        if r < rounds:
            steps.append(f"""book{r + 1} AS MATERIALIZED (
  WITH sums AS (SELECT p, e, i, sum(x)::BIGINT AS s, count(*) AS c
                FROM (SELECT p, e, unnest(part) AS x, unnest(generate_series(1, len(part))) AS i FROM near{r}) GROUP BY p, e, i),
       means AS (SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY i) AS mean FROM sums GROUP BY p, e)
  SELECT p, e, coalesce(mean, entry) AS entry FROM book{r} LEFT JOIN means USING (p, e)
)""")
    return ",\n".join(steps)


OP12 = f"""
WITH whole AS (
  SELECT vec_id, label, [floor(4096 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
kept AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, len(v) // 8 AS w FROM whole),
parts AS MATERIALIZED (
  SELECT r, p, v[p * w + 1 : (p + 1) * w] AS part FROM (SELECT *, unnest(generate_series(0, 7)) AS p FROM kept)
),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, part AS entry FROM parts WHERE r <= 16),
{_lloyd(6)},
codes AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near6 GROUP BY r),
named AS (SELECT vec_id, label, code, error FROM kept JOIN codes USING (r)),
labels AS (SELECT label, sum(error)::BIGINT AS label_error FROM named GROUP BY label),
numbers AS (
  SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book6
)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM named JOIN labels ON named.label IS NOT DISTINCT FROM labels.label CROSS JOIN numbers
"""

# Links from the documents that hold each shingle; components by rounds of smaller ids.
OP13 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 1, 1))) AS i FROM words WHERE len(w) > 0)
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
kinds AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS kind FROM (SELECT doc_id, sha256(string_agg(s, chr(10) ORDER BY s)) AS k FROM sets GROUP BY doc_id)
),
firsts AS MATERIALIZED (SELECT s, doc_id, n FROM sets JOIN sizes USING (doc_id) WHERE doc_id IN (SELECT kind FROM kinds)),
links AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM firsts x JOIN firsts y ON x.s = y.s AND x.doc_id <> y.doc_id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))
),
reach AS (
  SELECT DISTINCT kind AS a, kind AS b FROM kinds
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
parts AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       coalesce(component_id, doc_id) = doc_id AS kept
FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN kinds USING (doc_id) LEFT JOIN parts ON a = kind
"""

ORACLES = {"op1_url_filter": OP1, "op2_exact_topk": OP2, "op4_decontamination": OP4, "op6_warc": OP6, "op11_periodic_runs": OP11, "op12_vector_codes": OP12, "op13_minhash": OP13}
