"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from tagtable.llm import (hard_negatives, jaccard_join, language_id, lattice_lm, license_scan, merkle_manifest, metric_range_join, mixing, packing,
                          permutation_index, secret_scan, substring_dedup, voronoi_knn)

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1,
    "op2_ngram_jaccard_join": jaccard_join.op2,
    "op3_mix_sources": mixing.op3,
    "op4_secret_scan": secret_scan.op4,
    "op5_lattice_lm": lattice_lm.op5,
    "op6_best_fit_packing": packing.op6,
    "op7_license_scan": license_scan.op7,
    "op8_voronoi_knn_join": voronoi_knn.op8,
    "op9_language_id": language_id.op9,
    "op10_permutation_index": permutation_index.op10,
    "op11_metric_range_join": metric_range_join.op11,
    "op12_hard_negatives": hard_negatives.op12,
    "op13_merkle_manifest": merkle_manifest.op13,
}

ORACLE: dict[str, str] = {
    "op1_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
p AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
g AS (SELECT doc_id, unnest(range(1, len(words) - 11)) AS i, words FROM w WHERE len(words) >= 13),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(words[i : i + 12], ' ')) AS first_doc FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM f WHERE first_doc < doc_id),
k AS (SELECT p.doc_id, count(c.i) AS n_removed, string_agg(word, ' ' ORDER BY p.i) FILTER (WHERE c.i IS NULL) AS kept
      FROM p LEFT JOIN c ON p.doc_id = c.doc_id AND p.i = c.i GROUP BY p.doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id""",
    "op3_mix_sources": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  ('0x' || left(md5(coalesce(doc_id::VARCHAR, '')), 8))::BIGINT AS place FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS source_docs FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
q AS (SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0) AS left_words,
             sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight
      FROM w WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT *, 3 * source_size::HUGEINT * left_weight >= left_words::HUGEINT * weight AS is_open FROM q),
l AS (SELECT left_words::DOUBLE / left_weight::DOUBLE AS share FROM o WHERE is_open
      ORDER BY source_size / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, source_docs, CASE WHEN is_open THEN (SELECT share FROM l) * weight ELSE (3 * source_size)::DOUBLE END AS target FROM o),
r AS (SELECT d.*, source_size, source_docs, target,
             row_number() OVER (PARTITION BY d.source ORDER BY size DESC, place, doc_id NULLS FIRST) AS by_size,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
             ('0x' || left(md5('mix:' || coalesce(d.source, '')), 8))::BIGINT / 4294967296.0::DOUBLE AS offs
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, rate - floor(rate) AS part, floor((by_size - 1) * (rate - floor(rate))) AS stretch FROM r),
b AS (SELECT *, CASE WHEN part > 0 AND stretch % 2 = 1
                     THEN ceil(stretch / part) + 1 + least(ceil((stretch + 1) / part), source_docs) - by_size
                     ELSE by_size END AS rank FROM f),
c AS (SELECT *, (floor(rank * rate + offs) - floor((rank - 1) * rate + offs))::BIGINT AS copies FROM b)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM c""",
    "op8_voronoi_knn_join": r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, d.vec_id,
             list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * d.e[i]))::BIGINT AS score
      FROM v q JOIN v d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op11_metric_range_join": r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS least FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, c.least) AS component_id, coalesce(c.least, vec_id) >= vec_id AS kept
FROM embeddings LEFT JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a""",
    "op12_hard_negatives": r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
             list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * c.e[i]))::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS positive_rank FROM s WHERE same),
n AS (SELECT p.anchor_id, positive_id, positive_score, positive_rank, vec_id AS negative_id, score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_rank ORDER BY score DESC, vec_id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND positive_rank <= 5
       AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score, positive_rank FROM n WHERE rank <= 10""",
    "op13_merkle_manifest": r"""
WITH RECURSIVE f AS (
  SELECT doc_id, source, text,
         coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head,
         -- crc32 of the decimal doc_id: each byte is xored in, then eight steps of the polynomial
         list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
             lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) ELSE xor(c >> 1, 3988292384 * (c & 1)) END) AS crc
  FROM documents),
t AS (SELECT *, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed FROM f),
l AS (SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
             sha256(head || coalesce(octet_length(encode(changed)) || ':' || changed, '-')) AS tampered FROM t),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM l),
-- the nodes of each source's tree, level by level, while more than one node remains
nodes AS (
  SELECT 0 AS lvl, source, idx, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT lvl, source, idx, h, count(*) OVER (PARTITION BY source) FROM (
    SELECT any_value(lvl) + 1 AS lvl, source, idx // 3 AS idx, sha256(string_agg(h, '' ORDER BY idx)) AS h
    FROM nodes WHERE n > 1 GROUP BY source, idx // 3)),
subs AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, idx, h, count(*) OVER () AS n FROM subs
  UNION ALL
  SELECT lvl, idx, h, count(*) OVER () FROM (
    SELECT any_value(lvl) + 1 AS lvl, idx // 3 AS idx, sha256(string_agg(h, '' ORDER BY idx)) AS h
    FROM tops WHERE n > 1 GROUP BY idx // 3)),
-- one row for each leaf and level: the siblings to the left and to the right
low AS (SELECT a.lvl, a.source, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS lft,
               coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS rgt
        FROM nodes a JOIN nodes b ON a.lvl = b.lvl AND a.source IS NOT DISTINCT FROM b.source AND a.idx // 3 = b.idx // 3
        WHERE a.n > 1 GROUP BY a.lvl, a.source, a.idx),
high AS (SELECT a.lvl, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS lft,
                coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS rgt
         FROM tops a JOIN tops b ON a.lvl = b.lvl AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY a.lvl, a.idx),
steps AS (SELECT e.source, e.idx, low.lvl AS lvl, lft, rgt
          FROM leaves e JOIN low ON e.source IS NOT DISTINCT FROM low.source AND e.idx // (3 ** low.lvl)::BIGINT = low.idx
          UNION ALL
          SELECT e.source, e.idx, 1000 + high.lvl, lft, rgt
          FROM leaves e JOIN subs ON e.source IS NOT DISTINCT FROM subs.source JOIN high ON subs.idx // (3 ** high.lvl)::BIGINT = high.idx),
w AS (SELECT source, idx, string_agg(lft || rgt, '' ORDER BY lvl) AS proof, list([lft, rgt] ORDER BY lvl) AS path FROM steps GROUP BY source, idx),
r AS (SELECT doc_id, leaf, subs.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
             list_reduce(list_concat([[tampered, '']], coalesce(path, [])), lambda a, s: [sha256(s[1] || a[1] || s[2]), ''])[1] AS folded_root
      FROM leaves JOIN subs ON leaves.source IS NOT DISTINCT FROM subs.source
      LEFT JOIN w ON leaves.source IS NOT DISTINCT FROM w.source AND leaves.idx = w.idx)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM r""",
}
