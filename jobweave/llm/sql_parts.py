"""Oracle SQL of the operators that SQL can express, for DuckDB."""

from __future__ import annotations

from jobweave.llm.decontaminate import SHINGLE
from jobweave.llm.line_dedup import BASE, DIVISOR, MIN_LINES, PRIME
from jobweave.llm.sharding import SHARDS, SLOTS


def words(column: str) -> str:
    return f"list_filter(string_split_regex(coalesce({column}, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


LINE_DEDUP = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS doc, text,
         string_split(text, chr(10)) AS lines
  FROM documents
), l AS (
  SELECT rid, doc, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d WHERE text IS NOT NULL
), h AS (
  SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS hash FROM l
), b AS (
  SELECT *, (hash % {PRIME} + lag(hash, 1, 0) OVER (PARTITION BY rid ORDER BY i) * {BASE} % {PRIME}) % {PRIME} AS rolled FROM h
), e AS (
  SELECT *, coalesce(sum(CASE WHEN i >= 2 AND rolled % {DIVISOR} = 0 THEN 1 ELSE 0 END)
    OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM b
), k AS (
  SELECT rid, doc, c, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n,
         count(*) FILTER (regexp_matches(line, '[^\\x20\\x09-\\x0D]')) AS worded
  FROM e GROUP BY rid, doc, c
), o AS (
  SELECT *, n >= {MIN_LINES} AND worded >= {MIN_LINES} AS long FROM k
), f AS (
  SELECT *, long AND (min(doc) OVER (PARTITION BY long, body) < doc
    OR row_number() OVER (PARTITION BY rid, long, body ORDER BY c) > 1) AS gone FROM o
), g AS (
  SELECT rid, sum(n)::BIGINT AS n_lines, coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_lines_removed,
         coalesce(string_agg(body, chr(10) ORDER BY c) FILTER (NOT gone), '') AS kept
  FROM f GROUP BY rid
)
SELECT d.doc_id, g.kept AS text, coalesce(n_lines, 0) AS n_lines, coalesce(n_lines_removed, 0) AS n_lines_removed
FROM d LEFT JOIN g USING (rid)
"""

_SHARD_HASH = "('0x' || substr(md5('shard-' || i || chr(1) || '{}'), 1, 8))::BIGINT"

SHARDING = f"""
WITH RECURSIVE prefs AS (
  SELECT list({_SHARD_HASH.format("offset")} % {SLOTS} ORDER BY i) AS offs,
         list({_SHARD_HASH.format("skip")} % {SLOTS - 1} + 1 ORDER BY i) AS skips
  FROM range({SHARDS}) t(i)
), fill AS (
  SELECT 0 AS turn, list_transform(range({SLOTS}), lambda x: -1) AS slots, list_transform(range({SHARDS}), lambda x: 0) AS nxt
  UNION ALL
  SELECT turn + 1, list_transform(range({SLOTS}), lambda s: CASE WHEN s = pos THEN turn % {SHARDS} ELSE slots[s + 1] END),
         list_transform(range({SHARDS}), lambda s: CASE WHEN s = turn % {SHARDS} THEN j + 1 ELSE nxt[s + 1] END)
  FROM (
    SELECT *, (o + j * k) % {SLOTS} AS pos
    FROM (
      SELECT turn, slots, nxt, o, k,
             list_filter(range(nxt[turn % {SHARDS} + 1], {SLOTS}), lambda x: slots[((o + x * k) % {SLOTS}) + 1] = -1)[1] AS j
      FROM (SELECT fill.*, offs[turn % {SHARDS} + 1] AS o, skips[turn % {SHARDS} + 1] AS k FROM fill, prefs WHERE turn < {SLOTS})
    )
  )
), slots AS (
  SELECT unnest(slots) AS shard, generate_subscripts(slots, 1) - 1 AS slot FROM fill WHERE turn = {SLOTS}
), placed AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, chr(0))), 1, 8))::BIGINT % {SLOTS} AS slot FROM documents
)
SELECT doc_id, slot::INTEGER AS slot, shard::INTEGER AS shard FROM placed JOIN slots USING (slot)
"""


def _shingles(source: str, key: str) -> str:
    w = words("lower(text)")
    return f"""
  SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= {SHINGLE}
           THEN list_transform(range(1, len(w) - {SHINGLE} + 2), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM (SELECT {key}, {w} AS w FROM {source})"""


DECONTAMINATION = f"""
WITH docs AS ({_shingles("documents", "doc_id")}), items AS ({_shingles("benchmark", "item_id")}),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM items GROUP BY item_id),
hits AS (
  SELECT docs.doc_id, items.item_id, count(*) AS n_shared FROM docs JOIN items USING (shingle) GROUP BY ALL
)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM hits JOIN sizes USING (item_id) WHERE n_shared * 10 >= n_shingles * 8
"""

_ESCAPED = "replace(replace({}, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|')"

CHAT = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS lines,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length('<|im_start|>' || replace({_ESCAPED.format("role")}, chr(10), chr(92) || 'n') || chr(10)
           || {_ESCAPED.format("text")} || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
  FROM m GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars
FROM g
"""

QUALITY = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {words("text")} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), t AS (
  SELECT rid, generate_subscripts(w, 1) AS i, unnest(w) AS a FROM d
), t3 AS (
  SELECT rid, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM t WINDOW o AS (PARTITION BY rid ORDER BY i)
), often AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) > 1 AS twice FROM t3 WHERE c IS NOT NULL
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM often, range(3) r(k) WHERE twice GROUP BY rid
), f AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\\x00-\\x7F]'))) AS n_letter_words
  FROM d LEFT JOIN covered USING (rid)
), v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 10 * n_symbols <= n_words
       AND 10 * n_dup_lines <= 3 * n_lines AND 10 * n_letter_words >= 7 * n_words AS kept
FROM v
"""

# DuckDB has no base32: the digest's 160 bits, five at a time.
WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages
), m AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest, html) AS low FROM p
), b AS (
  SELECT *, array_to_string(list_transform(range(40), lambda i: right(('0x' || digest[i + 1])::INTEGER::BIT::VARCHAR, 4)), '') AS bits
  FROM m
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
         list_sum(list_transform(range(5), lambda k: bits[i * 5 + k + 1]::INTEGER * (1 << (4 - k)::INTEGER)))::INTEGER + 1]), '')
         AS payload_digest,
       CASE WHEN low IS NULL OR page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM low THEN low END AS refers_to
FROM b
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

URL_FILTER = f"""
WITH rules(verdict, rule, site, prefix) AS (
  VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
         ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
), r AS (
  SELECT row_number() OVER () AS rid, page_id,
         CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT rid, page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref)(=|\\z)'))) AS params
  FROM r
), c AS (
  SELECT *, CASE WHEN host <> '' THEN
      CASE WHEN starts_with(host, 'www.') THEN substr(host, 5) ELSE host END || rtrim(path, '/')
      || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical
  FROM p
), listed AS (
  SELECT DISTINCT canonical FROM c WHERE list_has_any(string_split(host, '.'), ['cheap-pills', 'spam-farm'])
), best AS (
  SELECT rid, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM c JOIN rules ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, prefix) GROUP BY rid
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN best USING (rid)
"""

# DuckDB has no CRC-32: a step for each byte of the decimal id and each of its bits.
PREFIX_TRIE = """
WITH RECURSIVE m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), t AS (
  SELECT conv_id, k, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS i
  FROM (SELECT conv_id, turn, sha256(length(role) || ':' || role || text) AS k, strlen(text)::BIGINT AS size FROM m)
), crc AS (
  SELECT DISTINCT conv_id, 0 AS step, 4294967295::BIGINT AS v FROM t
  UNION ALL
  SELECT conv_id, step + 1,
         CASE WHEN step % 9 = 0 THEN xor(v, ascii(substr(conv_id::VARCHAR, step // 9 + 1, 1))::BIGINT)
              WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END
  FROM crc WHERE step < 9 * length(conv_id::VARCHAR)
), c AS (
  SELECT conv_id, xor(v, 4294967295::BIGINT) % 9 AS h FROM crc WHERE step = 9 * length(conv_id::VARCHAR)
), u AS (
  SELECT c.conv_id, 0 AS own, i, k, size FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND i <= h
  UNION ALL SELECT c.conv_id, 1, i, k, size FROM c JOIN t ON t.conv_id = c.conv_id AND i > h
), r AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, i) AS depth, k, size FROM u
), p AS (
  SELECT conv_id, depth, size, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), n AS (
  SELECT path, left(path, greatest(length(path) - 64, 0)) AS up, min(depth) AS depth, min(conv_id) AS conv_id,
         count(*) AS n_convs, (count(*) - 1) * min(size) AS own
  FROM p GROUP BY path
), last AS (
  SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id
), e AS (
  SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ends FROM p JOIN last USING (conv_id, depth) GROUP BY path
), kids AS (
  SELECT up AS path, count(*) AS n FROM n WHERE depth > 0 GROUP BY up
), below AS (
  SELECT DISTINCT a.path, b.path AS under FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.depth <= b.depth
), s AS (
  SELECT below.path, sum(n.own) AS saved, count(*) FILTER (kids.n IS NULL) AS leaves
  FROM below JOIN n ON n.path = under LEFT JOIN kids ON kids.path = under GROUP BY below.path
)
SELECT n.conv_id, n.depth, CASE WHEN n.depth > 0 THEN o.conv_id END AS parent_conv_id, n.n_convs,
       coalesce(kids.n, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
       sha256(coalesce(e.ends, '')) AS ends_sha256
FROM n JOIN s USING (path) JOIN n o ON o.path = n.up LEFT JOIN kids ON kids.path = n.path LEFT JOIN e ON e.path = n.path
"""
