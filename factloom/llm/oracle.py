"""DuckDB SQL for those training-data queries that SQL can express."""

from __future__ import annotations

#: Every text's set of word 5-grams, all pairs that share one, exact similarity, connected components.
JACCARD = """WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '') ws FROM documents),
  g AS (SELECT DISTINCT doc_id, hash(CASE WHEN len(ws) >= 5 THEN array_to_string(ws[i:i + 4], ' ') ELSE 'short ' || array_to_string(ws, ' ') END) gram FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) i FROM w WHERE len(ws) > 0)),
  s AS (SELECT doc_id, count(*) n FROM g GROUP BY 1), c AS (SELECT gram, list(doc_id) docs FROM g GROUP BY 1 HAVING count(*) > 1),
  p AS (SELECT a, b, count(*) c FROM (SELECT a, unnest(docs) b FROM (SELECT unnest(docs) a, docs FROM c)) WHERE a <> b GROUP BY 1, 2),
  l AS (SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9 UNION ALL SELECT x.doc_id, y.doc_id FROM w x JOIN w y ON x.doc_id <> y.doc_id AND len(x.ws) = 0 AND len(y.ws) = 0),
  r AS (SELECT doc_id a, doc_id b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
  SELECT d.doc_id, min(r.b) AS class_id, (SELECT count(*) FROM l WHERE l.a = d.doc_id) AS n_links FROM documents d JOIN r ON r.a = d.doc_id GROUP BY 1"""

#: Every 100-byte window as hex, all but its first start cover their bytes.
REPEATS = """WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) x FROM documents), n AS (SELECT doc_id, x, length(x) // 2 n FROM h),
  w AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 200)) win FROM (SELECT doc_id, x, unnest(range(0, n - 99)) i FROM n WHERE n >= 100)),
  r AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1),
  e AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) k FROM r),
  v AS (SELECT doc_id, min(i) a, max(i) + 100 b FROM e GROUP BY doc_id, k),
  m AS (SELECT *, max(b) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) top FROM v),
  z AS (SELECT doc_id, a, b, sum(CASE WHEN top IS NULL OR a > top THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY a) k FROM m),
  u AS (SELECT doc_id, min(a) a, max(b) b FROM z GROUP BY doc_id, k),
  q AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) p FROM u),
  k AS (SELECT q.doc_id, string_agg(substr(x, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) x, max(b) b, sum(b - a) gone, count(*) spans FROM q JOIN n USING (doc_id) GROUP BY 1)
  SELECT n.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.x, '') || substr(n.x, 2 * coalesce(b, 0) + 1))) AS kept_sha256 FROM n LEFT JOIN k USING (doc_id)"""

ORACLE_SQL: dict[str, str] = {"op3_suffix_array_dedup": REPEATS, "op5_ngram_jaccard_join": JACCARD}
