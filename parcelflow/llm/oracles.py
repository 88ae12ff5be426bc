"""DuckDB SQL of the registered queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from parcelflow.llm import url_filter

EMBEDDING_TOP_K = """
WITH valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
usual AS (SELECT len(v) AS n FROM valid GROUP BY 1 ORDER BY count(*) DESC, n DESC LIMIT 1),
vectors AS (SELECT vec_id, min(v) AS v FROM valid WHERE len(v) = (SELECT n FROM usual) GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.v, x.v)::BIGINT AS score
  FROM vectors q JOIN vectors x ON q.vec_id % 20 = 0 AND q.vec_id <> x.vec_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

EXACT_DEDUP = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS nth,
    first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM plain
)
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, text_sha256 FROM ranked
"""

_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in url_filter.RULES)
_HOSTS = ", ".join(f"('{host}')" for host in url_filter.BLOCKED_HOSTS)
URL_VERDICTS = rf"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULES}),
blocked(blocked_host) AS (VALUES {_HOSTS}),
parsed AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
urls AS (SELECT DISTINCT host, path FROM parsed),
fitting AS (
  SELECT host, path, rule_host || rule_path AS rule, verdict,
    row_number() OVER (PARTITION BY host, path ORDER BY length(rule_host || rule_path) DESC) AS nth
  FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
),
bad AS (SELECT DISTINCT host FROM urls JOIN blocked ON host = blocked_host OR ends_with(host, '.' || blocked_host))
SELECT page_id, p.host, p.path, f.rule, coalesce(f.verdict, CASE WHEN b.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM parsed p LEFT JOIN fitting f ON p.host = f.host AND p.path = f.path AND f.nth = 1 LEFT JOIN bad b ON p.host = b.host
"""

ORACLES = {"op2_pivot_topk": EMBEDDING_TOP_K, "op7_exact_dedup": EXACT_DEDUP, "op10_url_verdicts": URL_VERDICTS}
