"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {g + 1}, 5))::INT >> {s}) & 31) + 1, 1)"
    for g in range(0, 40, 5) for s in (15, 10, 5, 0))

ORACLE["op4_warc_archive"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     f AS (SELECT body, min(page_id) AS first_id FROM p GROUP BY body),
     j AS (SELECT p.page_id, p.body, f.first_id, sha1(p.body) AS h FROM p JOIN f USING (body))
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM j
"""

#: Links (a, b) both ways and every node: the smallest node that each reaches.
_REACH = """
     reach(node, low) AS (SELECT node, node FROM nodes
                          UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.node),
     named AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)
"""

ORACLE["op5_min_max_hashing"] = f"""
WITH RECURSIVE
     words AS (SELECT doc_id, list_filter(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
     sets AS (SELECT doc_id, CASE
                  WHEN len(w) >= 3 THEN list_distinct(list_transform(
                      range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
     single AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
     pairs AS (SELECT x.doc_id AS a, y.doc_id AS b FROM single x JOIN single y USING (shingle)
               WHERE x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id, x.n, y.n
               HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
     links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
     nodes AS (SELECT doc_id AS node FROM documents),
     {_REACH}
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s JOIN named ON node = s.doc_id
"""

ORACLE["op6_rotation_codes"] = f"""
WITH RECURSIVE
     vectors AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
                 WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                   AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
     pairs AS (SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.vec_id < y.vec_id
               AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.95),
     links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
     nodes AS (SELECT vec_id AS node FROM embeddings),
     {_REACH}
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id) AS n_links, component_id,
       v.vec_id = component_id AS kept
FROM embeddings v JOIN named ON node = v.vec_id
"""

ORACLE["op7_spaced_seeds"] = """
WITH doc AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS w
             FROM documents WHERE text IS NOT NULL),
     one AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM doc),
     item AS (SELECT min(item_id) AS item_id, w FROM (
                  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS w
                  FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0 GROUP BY w),
     part AS (SELECT item_id, len(w) AS n, least(len(w), 20) AS width, unnest(w) AS word,
                     generate_subscripts(w, 1) AS k FROM item),
     hits AS (SELECT doc_id, item_id, n, width, place - k AS shift, list(k) AS ks
              FROM one JOIN part USING (word) GROUP BY ALL HAVING count(*) >= 0.8 * width),
     best AS (SELECT *, list_max(list_transform(range(1, n - width + 2),
                  lambda s: len(list_filter(ks, lambda k: k >= s AND k < s + width)))) AS most FROM hits)
SELECT doc_id, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS item_ids,
       max(len(ks))::INTEGER AS matched
FROM best WHERE most >= 0.8 * width GROUP BY doc_id
"""

_KEPT = """kept AS (SELECT vec_id, row_number() OVER () AS spot,
                   list_transform(embedding::DOUBLE[], lambda x: floor(64 * x)::BIGINT) AS v FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


def _zone_rounds(rounds: int) -> str:
    """Assignments ``near0 ..`` and centroids ``mid0 ..`` of every round."""
    parts = ["""mid0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM kept
              ORDER BY c LIMIT 16)"""]
    for r in range(rounds + 1):
        parts.append(f"""far{r} AS (SELECT spot, c, list_sum(list_transform(range(1, 65),
                  lambda i: (kept.v[i] - m.v[i]) * (kept.v[i] - m.v[i])))::BIGINT AS d FROM kept, mid{r} m),
     near{r} AS (SELECT spot, min(c) AS c, min(d) AS d FROM (
                  SELECT *, min(d) OVER (PARTITION BY spot) AS least FROM far{r}) WHERE d = least GROUP BY spot)""")
        if r < rounds:
            parts.append(f"""sum{r} AS (SELECT n.c, i, sum(kept.v[i])::HUGEINT AS s, count(*)::HUGEINT AS n
                  FROM near{r} n JOIN kept USING (spot), range(1, 65) t(i) GROUP BY n.c, i),
     mid{r + 1} AS (SELECT m.c, coalesce(x.v, m.v) AS v FROM mid{r} m LEFT JOIN (
                  SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM sum{r} GROUP BY c) x USING (c))""")
    return ",\n     ".join(parts)


ORACLE["op12_zone_maps"] = f"""
WITH {_KEPT},
     {_zone_rounds(3)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM near3 JOIN kept USING (spot) JOIN mid3 m USING (c)
"""
