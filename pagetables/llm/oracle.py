"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP5 = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.text) AS text_sha256
FROM t JOIN g USING (text)
"""

#: Parameters of the mix: block 64 words, shards of 1048576 words and 16384 documents, seed 42.
OP8 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM s0),
s2 AS (SELECT *, [3, 1, 2][((rk - 1) % 3 + 1)::INT] AS weight, 2 * source_size AS cap,
         1.5::DOUBLE * sum(source_size) OVER () AS total FROM s1),
-- full sources leave, the rest share anew, until none is above its cap
fill(step, source, rk, weight, cap, capped, want) AS (
  SELECT 0, source, rk, weight, cap, false, total * weight / sum(weight) OVER () FROM s2
  UNION ALL
  SELECT step + 1, source, rk, weight, cap, now_capped,
    CASE WHEN now_capped THEN cap::DOUBLE
      ELSE (total - coalesce(sum(CASE WHEN now_capped THEN cap END) OVER (), 0))::DOUBLE / sum(CASE WHEN now_capped THEN 0 ELSE weight END) OVER () * weight END
  FROM (SELECT f.*, capped OR want > cap AS now_capped, (SELECT max(total) FROM s2) AS total FROM fill f)
  WHERE step < (SELECT count(*) FROM s2)),
s3 AS (SELECT s2.*, f.want AS target FROM s2 JOIN fill f ON f.rk = s2.rk WHERE f.step = (SELECT max(step) FROM fill)),
n AS (SELECT round(sum(target) / 64)::BIGINT AS blocks FROM s3),
q AS (SELECT rk, target / (2 * k + 1) AS q, k FROM s3, n, LATERAL (SELECT unnest(range(0, n.blocks + 1)) AS k)
      WHERE k <= 2 * s3.source_size / 64 + 10),
won AS (SELECT rk, count(*) AS blocks FROM (
  SELECT rk, q, row_number() OVER (ORDER BY q DESC, rk, k) AS place FROM q), n WHERE place <= n.blocks AND q > 0 GROUP BY rk),
s4 AS (SELECT s3.*, coalesce(won.blocks, 0) AS blocks,
         greatest(1, ceil(source_size / 1048576), ceil(docs / 16384))::BIGINT AS shards FROM s3 LEFT JOIN won USING (rk)),
e AS (SELECT d.doc_id, d.source, d.size, s4.source_size, s4.target, s4.rk, s4.blocks,
        ('0x' || substr(md5('42:shard:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % s4.shards AS shard,
        md5('42:' || coalesce(doc_id::VARCHAR, '')) AS k
      FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source),
h AS (SELECT rk, shard, blocks, sum(size)::BIGINT AS words FROM e GROUP BY rk, shard, blocks),
hq AS (SELECT rk, shard, blocks, words / (2 * k + 1) AS q, k FROM h, LATERAL (SELECT unnest(range(0, 2 * words // 64 + 20)) AS k)),
hw AS (SELECT rk, shard, count(*) AS quota FROM (
  SELECT *, row_number() OVER (PARTITION BY rk ORDER BY q DESC, shard, k) AS place FROM hq) WHERE place <= blocks AND q > 0 GROUP BY rk, shard),
o AS (SELECT h.rk, h.shard, ceil(words / 64)::BIGINT AS own, least(coalesce(quota, 0), 2 * ceil(words / 64))::BIGINT AS quota
      FROM h LEFT JOIN hw USING (rk, shard)),
o2 AS (SELECT *, CASE WHEN own > 0 THEN quota // own ELSE 0 END AS whole, CASE WHEN own > 0 THEN quota % own ELSE 0 END AS more,
         CASE WHEN own > 0 THEN ('0x' || substr(md5('42:start:' || rk || ':' || shard), 1, 8))::BIGINT % own ELSE 0 END AS start FROM o),
p AS (SELECT *, sum(size) OVER (PARTITION BY rk, shard ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS fin FROM e)
SELECT doc_id, source, size, source_size, target,
  (whole * size + greatest(0, least(fin, (start + more) * 64) - greatest(fin - size, start * 64))
   + greatest(0, least(fin, (start + more - own) * 64) - (fin - size)))::BIGINT AS taken
FROM p JOIN o2 USING (rk, shard)
"""


#: base32 from hex: five hex digits are four letters.
OP9 = """
WITH t AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, body, octet_length(body)::BIGINT AS n, sha1(body) AS hx, min(page_id) OVER (PARTITION BY body) AS first FROM t)
SELECT page_id, n AS payload_bytes,
  list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform(range(0, 4), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(hx, (i * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * j)::BIGINT) & 31) + 1, 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM h
"""


OP12 = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units,
  ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM t),
c AS (SELECT *, len(units)::BIGINT AS n, h1 % (len(units) + 1) AS x, h2 % (len(units) + 1) AS y FROM u),
p AS (SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
    WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
  array_to_string(units[1:least(x, y)], '') AS pre, array_to_string(units[least(x, y) + 1:greatest(x, y)], '') AS mid,
  array_to_string(units[greatest(x, y) + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""


#: crc32 from the bits of the id's digits; nodes are named by the turns that lead to them.
OP13 = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)
  ), 4294967295::BIGINT) % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
g AS (SELECT c.*, least(h, (SELECT count(*) FROM t WHERE t.conv_id = c.base)) AS got FROM c),
r AS (SELECT g.conv_id, p, role, text FROM g JOIN t ON t.conv_id = g.base AND p <= g.h
  UNION ALL SELECT g.conv_id, p - h + got, role, text FROM g JOIN t ON t.conv_id = g.conv_id AND p > h),
n AS (SELECT conv_id, count(*) OVER (PARTITION BY conv_id) AS turns, p AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    md5(array_to_string(list(sha256(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY p), ',')) AS k FROM r),
m AS (SELECT conv_id, turns, depth, words, k FROM n
  UNION ALL SELECT conv_id, coalesce((SELECT max(turns) FROM n WHERE n.conv_id = g.conv_id), 0), 0, 0, 'root' FROM g),
up AS (SELECT a.*, b.k AS above FROM m a LEFT JOIN m b ON b.conv_id = a.conv_id AND b.depth = a.depth - 1),
d AS (SELECT depth, k, max(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = depth), '')) AS ends_sha256 FROM up GROUP BY depth, k),
f AS (SELECT d.*, (SELECT count(*) FROM d e WHERE e.above = d.k AND e.depth = d.depth + 1) AS n_children FROM d),
w AS (SELECT m.depth, m.k, sum((f.n_children = 0)::INT) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved
  FROM f JOIN m ON m.conv_id = f.conv_id AND m.depth <= f.depth GROUP BY m.depth, m.k)
SELECT f.conv_id, f.depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, w.n_leaves::BIGINT AS n_leaves,
  w.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN w ON w.depth = f.depth AND w.k = f.k LEFT JOIN f q ON q.k = f.above AND q.depth = f.depth - 1
"""


def oracle_sql() -> dict[str, str]:
    return {"op13_conversation_trie": OP13, "op5_exact_dedup": OP5, "op8_mix_sources": OP8, "op9_warc": OP9, "op12_fill_in_middle": OP12}
