"""SQL counterparts of the operators' queries, where SQL can express them."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM d WINDOW same AS (PARTITION BY body)
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 100 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes < 100 OR page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM f
"""

HOST_REPUTATION = f"""
WITH o AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id
), u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), s AS (
  SELECT page_id, {LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), q AS (
  SELECT s.*, o.bad, '.' || host AS dotted,
         array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
         list_extract(string_split(host, '.'), -1) AS suffix
  FROM s LEFT JOIN o ON o.doc_id = try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})', 1), '') AS BIGINT)
), h AS (
  SELECT host, domain, suffix, count(bad) AS n, coalesce(sum(bad), 0)::DOUBLE AS b FROM q GROUP BY ALL
), d AS (SELECT domain, suffix, sum(n)::DOUBLE AS n, sum(b) AS b FROM h GROUP BY ALL),
x AS (SELECT suffix, sum(n)::DOUBLE AS n, sum(b) AS b FROM d GROUP BY ALL),
t AS (SELECT sum(b) / sum(n) AS overall FROM x),
m AS (
  SELECT 'x' AS level, sum(n) AS n, sum(b) AS b, count(*) AS k, sum(n * n) AS nn, sum(b * b / n) AS bb
  FROM x WHERE n > 0
  UNION ALL SELECT 'd', sum(n), sum(b), count(*), sum(n * n), sum(b * b / n)
  FROM d WHERE n > 0 GROUP BY suffix
  UNION ALL SELECT 'h', sum(n), sum(b), count(*), sum(n::DOUBLE * n), sum(b * b / n)
  FROM h WHERE n > 0 GROUP BY suffix, domain
), r AS (
  SELECT level, sum(bb - n * (b / n) * (b / n) - (b / n) * (1 - b / n) * (k - 1)) AS excess,
         sum((b / n) * (1 - b / n) * (n - nn / n - (k - 1))) AS weight
  FROM m GROUP BY level
), c AS (
  SELECT level,
         1 / least(greatest(CASE WHEN weight > 1e-12 THEN excess / weight ELSE 1e-4 END, 1e-4), 0.99) - 1 AS strength
  FROM r
), xr AS (
  SELECT suffix, (b + strength * overall) / (n + strength) AS rate FROM x, t, c WHERE level = 'x'
), dr AS (
  SELECT domain, d.suffix, (b + strength * rate) / (n + strength) AS rate
  FROM d JOIN xr USING (suffix), c WHERE level = 'd'
), hr AS (
  SELECT host, (b + strength * rate) / (n + strength) AS rate, n + strength AS mass
  FROM h JOIN dr USING (domain, suffix), c WHERE level = 'h'
)
SELECT page_id, host, path,
       CASE WHEN ends_with(dotted, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
            WHEN ends_with(dotted, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
            WHEN ends_with(dotted, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
            WHEN ends_with(dotted, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
            WHEN ends_with(dotted, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule,
       CASE WHEN ends_with(dotted, '.www.example.com') AND starts_with(path, '/en/') THEN 'allow'
            WHEN ends_with(dotted, '.example.com') AND starts_with(path, '/en/') THEN 'block'
            WHEN ends_with(dotted, '.net') AND (starts_with(path, '/es/') OR starts_with(path, '/fr/')) THEN 'block'
            WHEN ends_with(dotted, '.com') AND starts_with(path, '/') THEN 'allow'
            WHEN rate - 1.645 * sqrt(rate * (1 - rate) / (mass + 1)) > 0.3 THEN 'block'
            ELSE 'allow' END AS verdict
FROM q JOIN hr USING (host)
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), s AS (
  SELECT r, unnest(range(1, len(words) - 33)) AS pos, words FROM d WHERE len(words) >= 35
), w AS (
  SELECT r, pos, count(*) OVER (PARTITION BY array_to_string(list_slice(words, pos, pos + 34), ' ')) AS n FROM s
), g AS (
  SELECT DISTINCT r, unnest(range(pos, pos + 35)) AS pos FROM w WHERE n > 1
), x AS (
  SELECT r, list(pos) AS gone FROM g GROUP BY r
), k AS (
  SELECT doc_id, words, coalesce(gone, []) AS gone,
         list_filter(words, lambda v, i: NOT list_contains(coalesce(gone, []), i)) AS kept
  FROM d LEFT JOIN x USING (r)
)
SELECT doc_id, len(words) AS n_words, len(gone) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM k
"""

NEAR_COPIES = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'),
                     lambda w: w <> '') AS words
  FROM documents
), s AS (
  SELECT DISTINCT r, array_to_string(list_slice(words, pos, pos + 2), ' ') AS shingle
  FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS pos FROM d WHERE len(words) > 0)
), sizes AS (
  SELECT r, count(*) AS n, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS same FROM s GROUP BY r
), sets AS (
  SELECT same, min(r) AS node, any_value(n) AS n FROM sizes GROUP BY same
), t AS (SELECT s.r AS node, shingle FROM s JOIN sets ON s.r = sets.node),
c AS (
  SELECT a.node AS a, b.node AS b, count(*) AS common
  FROM t AS a JOIN t AS b ON a.shingle = b.shingle AND a.node < b.node GROUP BY ALL
), links AS (
  SELECT a, b FROM c JOIN sets AS x ON x.node = a JOIN sets AS y ON y.node = b
  WHERE 100 * common >= 85 * (x.n + y.n - common)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT node AS a, node AS b FROM sets
  UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
), roots AS (SELECT a AS node, min(b) AS root FROM reach GROUP BY a),
named AS (
  SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, root
  FROM d LEFT JOIN sizes AS z ON z.r = d.r LEFT JOIN sets ON sets.same = z.same LEFT JOIN roots ON roots.node = sets.node
), lows AS (SELECT *, CASE WHEN root IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY root) END AS component_id FROM named)
SELECT doc_id, n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM lows
"""

CONVERSATION_TRIE = r"""
WITH t AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS donor,
         xor(list_reduce(
           list_concat([4294967295::BIGINT],
                       list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
           lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM o), t
), b AS (
  SELECT c.conv_id, 0 AS part, i, role, text FROM c JOIN o ON o.conv_id = c.donor AND i < h
  UNION ALL SELECT c.conv_id, 1, i, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND i >= h
), p AS (
  SELECT conv_id, row_number() OVER w AS depth, text,
         string_agg(sha256(strlen(role) || ':' || role || text), '') OVER w AS path
  FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)
  UNION ALL SELECT conv_id, 0, '', '' FROM c
), l AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM p),
n AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * len(list_filter(regexp_split_to_array(any_value(text), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS saved,
         CASE WHEN bool_and(last) THEN 1 ELSE 0 END AS leaf,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
  FROM l GROUP BY depth, path
), u AS (SELECT unnest(range(depth + 1)) AS up, path, saved, leaf FROM n),
s AS (
  SELECT up AS depth, left(path, 64 * up) AS path, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves FROM u GROUP BY ALL
), k AS (SELECT depth - 1 AS depth, left(path, 64 * (depth - 1)) AS path, count(*) AS n FROM n WHERE depth > 0 GROUP BY ALL)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN s USING (depth, path) LEFT JOIN k USING (depth, path)
LEFT JOIN n AS q ON q.depth = n.depth - 1 AND q.path = left(n.path, 64 * (n.depth - 1))
"""

ORACLE = {
    "op2_warc": WARC,
    "op6_exact_dedup": EXACT_DEDUP,
    "op9_substring_dedup": SUBSTRING_DEDUP,
    "op10_host_reputation": HOST_REPUTATION,
    "op11_conversation_trie": CONVERSATION_TRIE,
    "op12_minhash": NEAR_COPIES,
}
