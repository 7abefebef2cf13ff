"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL
), s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), copies AS (
  SELECT d.doc_id, coalesce((SELECT min(b) FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE a = d.doc_id AND c = x.n AND c = y.n), d.doc_id) AS other FROM w d
)
SELECT w.doc_id, least(w.doc_id, coalesce(min(r.b), w.doc_id)) AS class_id,
       coalesce(max(k.n), 0)::BIGINT AS n_links, min(least(w.doc_id, c.other)) AS copy_id
FROM w LEFT JOIN reach r ON r.a = w.doc_id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY 1) k ON k.a = w.doc_id
LEFT JOIN copies c ON c.doc_id = w.doc_id
GROUP BY w.doc_id
"""

FIXITY = r"""
WITH r AS (
  SELECT page_id, concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Target-URI: ',
    coalesce(url, ''), chr(13), chr(10), 'Content-Length: ', strlen(coalesce(html, '')), chr(13), chr(10), chr(13), chr(10),
    coalesce(html, ''), chr(13), chr(10), chr(13), chr(10)) AS record FROM pages
), m AS (
  SELECT page_id, any_value(record) AS record, sha256(record) AS digest, sum(strlen(record))::BIGINT AS bytes
  FROM r GROUP BY page_id, sha256(record)
), p AS (
  SELECT *, (sum(bytes) OVER (ORDER BY page_id NULLS FIRST, digest) - bytes)::BIGINT AS "at",
    coalesce(('0x' || substr(md5('replica' || page_id::VARCHAR), 1, 8))::BIGINT, 2) AS code FROM m
)
SELECT page_id, "at", bytes, digest AS expected,
  CASE WHEN code % 193 <> 1 THEN sha256(concat(record[1:8], '~', record[10:])) END AS found
FROM p WHERE code % 97 = 0 OR code % 193 = 1
"""

CHAT = r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_replace(regexp_replace(replace(text, '\', '\\'), '<(/?s>|</?SYS>>)', '\\l\1', 'g'),
                           '\[(/?(INST|ROLE)\])', '\\b\1', 'g') AS body,
    regexp_replace(regexp_replace(replace(role, '\', '\\'), '<(/?s>|</?SYS>>)', '\\l\1', 'g'),
                           '\[(/?(INST|ROLE)\])', '\\b\1', 'g') AS who
  FROM m
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(9 + length(who) + 7 + length(body) + 5)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

MIX = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS k, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('mix-1' || coalesce(doc_id::VARCHAR, '')) AS code
  FROM documents
), src AS (
  SELECT k, source, sum(size)::BIGINT AS source_size, ceil(count(*) / 4096)::BIGINT AS shards FROM sized GROUP BY 1, 2
), wt AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM src
), lv AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS total,
    (sum(source_size) OVER ()::BIGINT - coalesce(sum(source_size * 3) OVER (lo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
      / (sum(w) OVER (lo ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level,
    row_number() OVER lo AS rk
  FROM wt WINDOW lo AS (ORDER BY source_size / w, source NULLS LAST)
), tg AS (
  SELECT *, CASE WHEN source_size * 3 > level * w THEN w * (SELECT arg_min(level, rk) FROM lv WHERE source_size * 3 > level * w)
    ELSE (source_size * 3)::DOUBLE END AS target FROM lv
), q1 AS (
  SELECT *, round(total / 16)::BIGINT AS seats, target / nullif(sum(target) OVER (), 0) AS share, count(*) OVER () AS m FROM tg
), q2 AS (
  SELECT *, greatest(0, floor(share * seats - share * m / 2 - 1))::BIGINT AS sure, ceil(share * seats + share * m / 2 + 1)::BIGINT AS most FROM q1
), won AS (
  SELECT k, count(*) AS won FROM (
    SELECT k, row_number() OVER (ORDER BY target / (2 * seat - 1) DESC, k, seat) AS place, seats - allsure AS free FROM (
      SELECT k, target, seats, sum(sure) OVER () AS allsure, sure, most FROM q2) q,
      LATERAL (SELECT unnest(range(sure + 1, most + 1)) AS seat) WHERE target > 0)
  WHERE place <= free GROUP BY 1
), served AS (SELECT q2.k, source_size, shards, target, sure + coalesce(won, 0) AS blocks FROM q2 LEFT JOIN won USING (k)),
placed AS (
  SELECT s.*, v.source_size, v.target, v.blocks, ('0x' || substr(code, 1, 8))::BIGINT % shards AS shard FROM sized s JOIN served v USING (k)
), sh AS (SELECT k, shard, blocks, sum(size)::BIGINT AS shard_size FROM placed GROUP BY 1, 2, 3),
r1 AS (
  SELECT *, coalesce(shard_size / nullif(sum(shard_size) OVER (PARTITION BY k), 0), 0) AS share, count(*) OVER (PARTITION BY k) AS m FROM sh
), r2 AS (
  SELECT *, greatest(0, floor(share * blocks - share * m / 2 - 1))::BIGINT AS sure, ceil(share * blocks + share * m / 2 + 1)::BIGINT AS most FROM r1
), won2 AS (
  SELECT k, shard, count(*) AS won FROM (
    SELECT k, shard, row_number() OVER (PARTITION BY k ORDER BY shard_size / (2 * seat - 1) DESC, shard, seat) AS place, blocks - allsure AS free FROM (
      SELECT k, shard, shard_size, blocks, sum(sure) OVER (PARTITION BY k) AS allsure, sure, most FROM r2) q,
      LATERAL (SELECT unnest(range(sure + 1, most + 1)) AS seat) WHERE shard_size > 0)
  WHERE place <= free GROUP BY 1, 2
), quota AS (SELECT r2.k, r2.shard, shard_size, (sure + coalesce(won, 0)) * 16 AS quota FROM r2 LEFT JOIN won2 ON won2.k = r2.k AND won2.shard = r2.shard),
run AS (
  SELECT p.*, q.shard_size, q.quota, coalesce(q.quota // nullif(q.shard_size, 0), 0) AS passes,
    coalesce(sum(size) OVER (PARTITION BY p.k, p.shard ORDER BY code, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM placed p JOIN quota q ON q.k = p.k AND q.shard = p.shard
)
SELECT doc_id, size, source_size, target,
  least(passes * size + greatest(0, least(size, quota - passes * shard_size - earlier)), size * 3)::BIGINT AS taken
FROM run
"""

CONVERSATION_TRIE = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS codes
), t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(list_concat([4294967295], list_transform(
      string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, x: xor(a >> 8, codes[(xor(a, x) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t), crc
), r AS (
  SELECT c.conv_id, t.i AS d, role, text FROM c JOIN t ON t.conv_id = c.base AND t.i <= h
  UNION ALL
  SELECT c.conv_id, least(h, (SELECT count(*) FROM t b WHERE b.conv_id = c.base)) + t.i - h, role, text
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > h
), s AS (
  SELECT conv_id, d, text, sha256(string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY d)) AS node FROM r
), path AS (
  SELECT conv_id, d, node, text FROM s UNION ALL SELECT conv_id, 0, '', '' FROM c
), n AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(strlen(text)) AS saved FROM path GROUP BY node, d
), up AS (
  SELECT n.*, p.node AS parent FROM n LEFT JOIN path p ON p.conv_id = n.conv_id AND p.d = n.d - 1
), kids AS (SELECT parent, count(*) AS k FROM up GROUP BY parent),
leafy AS (SELECT up.*, coalesce(k, 0) AS n_children FROM up LEFT JOIN kids ON kids.parent = up.node),
below AS (
  SELECT p.node, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved
  FROM leafy JOIN path p ON p.conv_id = leafy.conv_id AND p.d <= leafy.d GROUP BY p.node
), ends AS (
  SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(node, d) AS node FROM path GROUP BY conv_id) GROUP BY node
)
SELECT l.conv_id, l.d AS depth, p.conv_id AS parent_conv_id, l.n_convs, l.n_children, b.n_leaves::BIGINT AS n_leaves,
  b.saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM leafy l JOIN below b ON b.node = l.node LEFT JOIN n p ON p.node = l.parent LEFT JOIN ends ON ends.node = l.node
"""

# Links are resolved where they are absolute or begin with a slash, without dot segments.
URL_ALIASES = r"""
WITH RECURSIVE rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), p AS (
  SELECT row_number() OVER () AS row, page_id, url, html FROM pages
), links AS (
  SELECT row, url, unnest(regexp_extract_all(regexp_replace(coalesce(html, ''), '(?is)<!--.*?-->|<script\b.*?</script', ' ', 'g'),
    '(?is)<(?:link|meta)\s[^>]*>')) AS tag FROM p
), written AS (
  SELECT row, url, CASE
    WHEN tag ilike '<link%' AND regexp_matches(tag, '(?i)\srel\s*=\s*["'']?([^"''>]*\s)?canonical[\s"''>/]')
      THEN regexp_extract(tag, '(?is)\shref\s*=\s*["'']?([^"''\s>]*)', 1)
    WHEN tag ilike '<meta%' AND regexp_matches(tag, '(?i)\shttp-equiv\s*=\s*["'']?refresh[\s"''>/]')
      THEN regexp_extract(tag, '(?is)[;,]\s*url\s*=\s*["'']?([^"''\s>]*)', 1) END AS link FROM links
), said AS (
  SELECT row, url, CASE WHEN link LIKE '%://%' THEN link
    WHEN link LIKE '//%' THEN split_part(url, '://', 1) || ':' || link
    ELSE regexp_extract(url, '^.*?://[^/?#]*') || link END AS target
  FROM written WHERE url LIKE '%://%' AND (link LIKE '%://%' OR link LIKE '/%')
), urls AS (SELECT DISTINCT url FROM (SELECT url FROM p UNION ALL SELECT target FROM said)),
placed AS (
  SELECT url, rest, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(regexp_extract(rest, '^[^#]*'), '\?(.*)$', 1) AS query
  FROM (SELECT url, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest FROM urls)
), place AS (
  SELECT url, coalesce(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(path, '') AS path,
    CASE WHEN rest IS NOT NULL THEN
      regexp_replace(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ':(80|443)$', '')
      || rtrim(path, '/') || coalesce('?' || nullif(array_to_string(
        list_filter(string_split(query, '&'), lambda x: x <> '' AND x NOT LIKE 'utm\_%' ESCAPE '\'), '&'), ''), '') END AS node
  FROM placed
), edges AS (
  SELECT a.node AS u, b.node AS v FROM said JOIN place a ON a.url = said.url JOIN place b ON b.url = said.target
), both_ways AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
reach(u, v) AS (SELECT u, v FROM both_ways UNION SELECT r.u, b.v FROM reach r JOIN both_ways b ON b.u = r.v),
judged AS (
  SELECT p.row, p.page_id, place.host, place.path, place.node,
    arg_max(r.host || r.path, strlen(r.host || r.path)) AS rule, arg_max(r.verdict, strlen(r.host || r.path)) AS verdict
  FROM p JOIN place ON place.url IS NOT DISTINCT FROM p.url
  LEFT JOIN rules r ON ('.' || place.host) LIKE ('%.' || r.host) AND starts_with(place.path, r.path)
  GROUP BY ALL
), tainted AS (
  SELECT node FROM judged WHERE verdict = 'block'
  UNION SELECT reach.v FROM judged JOIN reach ON reach.u = judged.node WHERE verdict = 'block'
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN node IN (SELECT node FROM tainted) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
"""

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard": JACCARD,
    "op2_warc_fixity": FIXITY,
    "op7_chat_format": CHAT,
    "op10_source_mix": MIX,
    "op11_conversation_trie": CONVERSATION_TRIE,
    "op13_url_aliases": URL_ALIASES,
}
