"""The queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from .jaccard import op10_jaccard_join
from .licenses import op1_license_scan
from .media import op5_media_columns
from .mixing import op9_mix_sources
from .order_minhash import op6_order_minhash
from .packing import op8_pack_documents
from .quality import op3_quality_classifier
from .sharding import op4_shard_documents
from .substring import op7_shared_passages
from .tokens import op2_count_tokens

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_count_tokens": op2_count_tokens,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_shard_documents": op4_shard_documents,
    "op5_media_columns": op5_media_columns,
    "op6_order_minhash": op6_order_minhash,
    "op7_shared_passages": op7_shared_passages,
    "op8_pack_documents": op8_pack_documents,
    "op9_mix_sources": op9_mix_sources,
    "op10_jaccard_join": op10_jaccard_join,
}

ORACLE_SQL: dict[str, str] = {
    "op9_mix_sources": r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(concat_ws(':', doc_id::VARCHAR, '20240229')), 1, 3))::INT AS bucket FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), ranked AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM sources
), weighed AS (
  SELECT source, source_size, k, CASE k % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END::DOUBLE AS w, source_size::DOUBLE * 2 AS cap FROM ranked
), levels AS (
  SELECT cap / w AS ratio, k, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0)) / ((sum(w) OVER ()) - coalesce(sum(w) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), filled AS (
  SELECT source, source_size, least(cap, coalesce((SELECT level FROM levels WHERE level < ratio ORDER BY ratio, k LIMIT 1) * w, cap)) AS target FROM weighed
), whole AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size::DOUBLE + 1e-12::DOUBLE) ELSE 0 END::BIGINT AS whole FROM filled
), buckets AS (
  SELECT source, bucket, sum(size)::DOUBLE AS n, (sum(sum(size)) OVER (PARTITION BY source ORDER BY bucket))::DOUBLE AS upto FROM docs GROUP BY source, bucket
), parts AS (
  SELECT b.source, b.bucket, CASE WHEN n > 0 THEN greatest(0::DOUBLE, least(1::DOUBLE, ((target - (whole * source_size)::DOUBLE) - (upto - n)) / n)) ELSE 1 END AS part
  FROM buckets b JOIN whole w ON b.source IS NOT DISTINCT FROM w.source
), edges AS (
  SELECT source, min(bucket) AS edge, arg_min(part, bucket) AS part FROM parts WHERE part < 1 GROUP BY source
)
SELECT d.doc_id, d.size, w.source_size, w.target,
  (w.whole * d.size + CASE WHEN d.bucket < coalesce(e.edge, 4096) THEN d.size WHEN d.bucket > e.edge THEN 0 ELSE round(d.size * e.part) END)::BIGINT AS taken
FROM docs d JOIN whole w ON d.source IS NOT DISTINCT FROM w.source LEFT JOIN edges e ON d.source IS NOT DISTINCT FROM e.source
""",
    "op10_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w] ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS s FROM words
), ids AS MATERIALIZED (
  SELECT doc_id, hash(s) AS s FROM shingles
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM ids GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b FROM ids x JOIN ids y ON x.s = y.s AND x.doc_id < y.doc_id
  JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(node, other) AS (
  SELECT doc_id, doc_id FROM words UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a
)
SELECT w.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id FROM (SELECT DISTINCT doc_id FROM words) w
LEFT JOIN sizes s USING (doc_id) JOIN (SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY node) r USING (doc_id)
""",
}
