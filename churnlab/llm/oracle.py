"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

SQUEEZED = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')"

EXACT_DEDUP = f"""
WITH hashed AS (
  SELECT doc_id, length(coalesce(text, '')) AS own_chars, sha256({SQUEEZED}) AS text_sha256 FROM documents
), ranked AS (
  SELECT *,
    first_value(doc_id) OVER w AS keep_id,
    row_number() OVER w AS place,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM hashed
  WINDOW w AS (PARTITION BY text_sha256 ORDER BY own_chars DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

# The parameters are those of the mixing module. The exponent is bisected by a
# recursive query over the sources' shares.
MIXING = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents
), sources AS (
  SELECT source, sum(tokens)::BIGINT AS all_tokens FROM docs GROUP BY source
), shares AS (
  SELECT all_tokens / (SELECT sum(all_tokens)::DOUBLE FROM sources) AS s FROM sources WHERE all_tokens > 0
), facts AS (
  SELECT list(s) AS s, count(*) AS n, min(s) AS low, max(s) AS high FROM shares
), bisect(step, lower, upper) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, if(met, lower, middle), if(met, middle, upper)
  FROM (
    SELECT step, lower, upper, middle,
      ln(z) - middle * zl / z <= 0.95 * ln(n) + 1e-12 AND (low / high) ** (middle - 1) <= 2 + 1e-12 AS met
    FROM (
      SELECT step, lower, upper, (lower + upper) / 2 AS middle, n, low, high,
        list_sum(list_transform(s, lambda x: x ** ((lower + upper) / 2))) AS z,
        list_sum(list_transform(s, lambda x: x ** ((lower + upper) / 2) * ln(x))) AS zl
      FROM bisect, facts WHERE step < 40
    )
  )
), ends AS (
  SELECT upper AS a FROM bisect WHERE step = 40
), powers AS (
  SELECT source, all_tokens, (all_tokens / (SELECT sum(all_tokens)::DOUBLE FROM sources)) ** a AS p
  FROM sources, ends WHERE all_tokens > 0
), weights AS (
  SELECT source, all_tokens, round(p / (SELECT sum(p) FROM powers), 9) AS weight FROM powers
), total AS (
  SELECT max(ceil(all_tokens / weight))::BIGINT AS budget FROM weights WHERE weight > 0
), budgets AS (
  SELECT w.source, all_tokens, greatest(all_tokens, round(weight * t.budget)::BIGINT) AS budget,
    ceil(t.budget / 1000000)::BIGINT AS blocks
  FROM weights w, total t
  UNION ALL
  SELECT source, 0, 0, (SELECT greatest(1, ceil(budget / 1000000)::BIGINT) FROM total) FROM sources WHERE all_tokens = 0
), seen AS (
  SELECT doc_id, d.source, tokens, all_tokens, budget, blocks, epoch,
    md5('1|' || epoch || '|' || coalesce(doc_id::VARCHAR, 'null')) AS k
  FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source,
    unnest(range(CASE WHEN all_tokens > 0 THEN ceil(budget / all_tokens)::BIGINT ELSE 1 END)) AS e(epoch)
), placed AS (
  SELECT *, epoch * all_tokens + coalesce(sum(tokens) OVER (
    PARTITION BY source, epoch ORDER BY k, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM seen
), taken AS (
  SELECT *, least(CASE WHEN all_tokens > 0 THEN floor(start::DOUBLE / budget * blocks)
    ELSE ('0x' || substr(k, 1, 8))::BIGINT % blocks END, blocks - 1)::BIGINT AS block
  FROM placed WHERE start < budget OR all_tokens = 0
)
SELECT doc_id, source, tokens, epoch, block, row_number() OVER (PARTITION BY block ORDER BY k, source, tokens) AS rank FROM taken
"""

WARC = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
FROM firsts
"""

HARD_NEGATIVES = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id))::INT AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

ORACLE = {"op12_hard_negatives": HARD_NEGATIVES, "op1_mixing": MIXING, "op7_exact_dedup": EXACT_DEDUP, "op8_warc": WARC}
