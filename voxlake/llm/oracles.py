"""DuckDB SQL for the queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(pattern: str, table: str, key: str) -> str:
    return (f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),"
            f" '{pattern}') ws FROM {table}")


OP4 = f"""
WITH RECURSIVE w AS ({_words(r'[^\x20\x09-\x0D]+', 'documents', 'doc_id')}),
runs AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(ws) >= 5 THEN
      list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) run
  FROM w),
sizes AS (SELECT doc_id, count(*) n FROM runs GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id a, y.doc_id b, count(*) c
  FROM runs x JOIN runs y ON x.run = y.run AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b
  WHERE 100 * c >= 85 * (m.n + n.n - c)),
reach AS (
  SELECT doc_id a, doc_id b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(max(s.n), 0)::BIGINT n_shingles, min(r.b) component_id,
       min(r.b) = d.doc_id kept
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id"""

ALPHANUMERIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP9 = f"""
WITH w AS ({_words(ALPHANUMERIC, 'documents', 'doc_id')}),
b AS ({_words(ALPHANUMERIC, 'benchmark', 'item_id')}),
windows AS (
  SELECT item_id, len(ws) n, array_to_string(ws, ' ') win FROM b WHERE len(ws) BETWEEN 1 AND 9
  UNION
  SELECT item_id, 10, unnest(list_transform(range(1, len(ws) - 8),
    lambda i: array_to_string(ws[i:i + 9], ' '))) FROM b WHERE len(ws) >= 10),
runs AS (
  SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) place, unnest(list_transform(
    range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i + n - 1], ' '))) win
  FROM w, (SELECT DISTINCT n FROM windows) WHERE len(ws) >= n),
hits AS (SELECT doc_id, n, place, item_id FROM runs JOIN windows USING (n, win)),
words AS (
  SELECT doc_id, count(DISTINCT word) n_hit
  FROM (SELECT doc_id, unnest(range(place, place + n)) word FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) names
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT n_words, coalesce(n_hit, 0)::BIGINT n_hit,
       coalesce(n_items, 0)::BIGINT n_items, sha256(coalesce(names, '')) items_sha256,
       coalesce(n_hit, 0) > 0 contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP5 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) h, strlen(coalesce(text, '')) n
           FROM documents),
windows AS (
  SELECT doc_id, s, hash(substr(h, 2 * s + 1, 200)) a, md5(substr(h, 2 * s + 1, 200)) b
  FROM (SELECT doc_id, h, unnest(range(0, n - 99)) s FROM d WHERE n >= 100)),
repeated AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY a, b ORDER BY doc_id, s) nth FROM windows)
  WHERE nth > 1),
marked AS (
  SELECT doc_id, s, CASE WHEN s <= 100 + lag(s) OVER (PARTITION BY doc_id ORDER BY s)
    THEN 0 ELSE 1 END new FROM repeated),
numbered AS (
  SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) span FROM marked),
spans AS (
  SELECT doc_id, min(s) a, max(s) + 100 b FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER w, 0) a, a b FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id),
kept AS (
  SELECT g.doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) k
  FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id),
sums AS (SELECT doc_id, sum(b - a) n_removed, count(*) n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, n::BIGINT n_bytes, coalesce(n_removed, 0)::BIGINT n_removed,
       coalesce(n_spans, 0)::BIGINT n_spans, sha256(unhex(coalesce(k, h))) kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)"""

OP6 = f"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0
    THEN substr(url, instr(url, '://') + 3) END rest FROM pages),
u AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') path FROM cut),
listed AS (
  SELECT DISTINCT host || path address FROM u
  WHERE host LIKE '%-%' OR url LIKE '%utm_source=%'),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (
  SELECT page_id, arg_max(h || p, length(h || p)) rule, arg_max(verdict, length(h || p)) verdict
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict,
  CASE WHEN host || path IN (SELECT address FROM listed) THEN 'block' ELSE 'allow' END) verdict
FROM u LEFT JOIN best USING (page_id)"""

OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) q FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT rank,
         vec_id, score FROM scores)
SELECT * FROM ranked WHERE rank <= 5"""


def oracle_sql() -> dict[str, str]:
    return {"op4_near_duplicates": OP4, "op5_repeated_passages": OP5,
            "op6_url_filter": OP6,
            "op7_top_k": OP7, "op9_decontamination": OP9}
