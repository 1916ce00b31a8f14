"""SQL that must give the same rows, for the operators that SQL can express."""

from __future__ import annotations

from larder.llm.queries import SHARDS, SLOTS, WEIGHTS

_NAMES = ", ".join(f"({i}, '{name}')" for i, name in enumerate(SHARDS))

# One row per turn: the list of slots, and how far each shard has gone in its order of preference.
_OP2 = f"""
WITH RECURSIVE shards(i, name) AS (VALUES {_NAMES}),
orders AS (
  SELECT list(('0x' || substr(md5(name), 1, 8))::BIGINT % {SLOTS} ORDER BY i) AS begins,
         list(('0x' || substr(md5(name), 9, 8))::BIGINT % {SLOTS - 1} + 1 ORDER BY i) AS steps
  FROM shards
),
filled AS (
  SELECT 0 AS turn, list_transform(range({SLOTS}), lambda x: -1) AS slots,
         list_transform(range({len(SHARDS)}), lambda x: 0) AS tried
  UNION ALL
  SELECT turn + 1,
         list_transform(slots, lambda s, k: CASE
           WHEN k - 1 = (begins[turn % {len(SHARDS)} + 1] + j * steps[turn % {len(SHARDS)} + 1]) % {SLOTS}
           THEN turn % {len(SHARDS)} ELSE s END),
         list_transform(tried, lambda s, k: CASE WHEN k - 1 = turn % {len(SHARDS)} THEN j + 1 ELSE s END)
  FROM (
    SELECT *, list_filter(range(tried[turn % {len(SHARDS)} + 1], {SLOTS}), lambda j:
      slots[(begins[turn % {len(SHARDS)} + 1] + j * steps[turn % {len(SHARDS)} + 1]) % {SLOTS} + 1] = -1)[1] AS j
    FROM filled, orders WHERE turn < {SLOTS}
  )
),
lookup AS (
  SELECT unnest(range({SLOTS})) AS slot, unnest(slots) AS i FROM filled WHERE turn = {SLOTS}
)
SELECT d.doc_id, l.slot::INTEGER AS slot, s.name AS shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents) d
JOIN lookup l USING (slot) JOIN shards s USING (i)
"""

# Plain running sums over whole sources; the Spark side works in three levels.
_OP3 = f"""
WITH sized AS (
  SELECT doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source IS NULL, encode(source)) AS place
  FROM sized GROUP BY source
),
weighed AS (
  SELECT *, [{", ".join(f"{w}::DOUBLE" for w in WEIGHTS)}][((place - 1) % {len(WEIGHTS)} + 1)::INTEGER] AS weight,
         2.0::DOUBLE * source_size AS cap
  FROM sources
),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (
  SELECT source, source_size,
         least(cap, max(level) OVER () * weight) AS target
  FROM levels
),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, md5('0:' || coalesce(s.doc_id::VARCHAR, '')), s.doc_id) AS nth,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size * 4294967296.0::DOUBLE)::HUGEINT ELSE 0 END AS each,
         ('0x' || substr(md5('0/' || (s.source IS NOT NULL)::VARCHAR || '/' || coalesce(s.source, '')), 1, 8))::HUGEINT AS shift
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (((each * nth + shift) // 4294967296 - (each * (nth - 1) + shift) // 4294967296) * size)::BIGINT AS taken
FROM placed
"""

_ESCAPED = "replace(replace(replace({0}, '\\', '\\\\'), '<', '\\('), '>', '\\)')"
_OP5 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS learned,
         sum(length('<turn ' || {_ESCAPED.format("role")} || '>' || {_ESCAPED.format("text")} || '</turn>' || chr(10)))::BIGINT
           AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(learned)::BIGINT AS loss_chars,
       sha256(learned) AS loss_sha256, formatted_chars
FROM joined
"""

_OP8 = """
WITH points AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, p.vec_id, list_inner_product(q.v::DOUBLE[], p.v::DOUBLE[])::BIGINT AS score
  FROM points q JOIN points p ON q.vec_id % 20 = 0 AND p.vec_id <> q.vec_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_OP13 = """
WITH payloads AS (
  SELECT page_id, url, coalesce(html, '') AS body FROM pages
),
ranked AS (
  SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, sha256(body) AS payload_digest,
         row_number() OVER first_page AS place, first_value(page_id) OVER first_page AS first_id
  FROM payloads
  WINDOW first_page AS (PARTITION BY body ORDER BY page_id NULLS LAST, url NULLS FIRST)
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN first_id END AS refers_to
FROM ranked
"""

ORACLE_SQL = {
    "op2_shard_placement": _OP2,
    "op3_source_mix": _OP3,
    "op5_chat_format": _OP5,
    "op8_top_inner_products": _OP8,
    "op13_warc_archives": _OP13,
}
