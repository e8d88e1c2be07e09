"""DuckDB SQL with the results of the queries that SQL can express."""

from __future__ import annotations

_WS = r"[\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"list_filter(regexp_split_to_array(coalesce({{}}, ''), '{_WS}'), lambda x: x <> '')"

SQL: dict[str, str] = {}

SQL["op3_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format('text')} AS words,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), w AS (
  SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d
), g AS (
  SELECT doc_id, i, w AS a, lead(w, 1) OVER p AS b, lead(w, 2) OVER p AS c FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)
), r AS (
  SELECT doc_id, i FROM g WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY doc_id
), dup AS (
  SELECT doc_id, sum(n - 1) AS n FROM (
    SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(lines) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines, length(regexp_replace(text, '[^A-Za-z\x{{80}}-\x{{10FFFF}}]', '', 'g')) AS n_letters,
         length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)
), f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END + CASE WHEN n_lines > 3 AND 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 25 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_letters < 50 * word_chars THEN 64 ELSE 0 END + CASE WHEN 100 * n_digits > 30 * word_chars THEN 128 ELSE 0 END)::BIGINT AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed FROM f
"""

SQL["op10_line_dedup"] = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), k AS (
  SELECT *, {_LOWER.format("regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')")} AS key FROM l
), many AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), m AS (
  SELECT doc_id, i, line, key IN (SELECT key FROM many) AS gone FROM k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

SQL["op1_suffix_array_dedup"] = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS k FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM d)
), r AS (
  SELECT doc_id, i FROM w QUALIFY count(*) OVER (PARTITION BY k) > 1
), o AS (
  SELECT doc_id, i, i > lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) + 200 AS fresh FROM r
), g AS (
  SELECT doc_id, i, count(*) FILTER (fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM o
), s AS (
  SELECT doc_id, span, min(i) AS a, max(i) + 200 AS b FROM g GROUP BY doc_id, span
), p AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM s
), c AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM p JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""

SQL["op2_substring_dedup"] = rf"""
WITH d AS (
  SELECT doc_id, {_WORDS.format('text')} AS words FROM documents
), w AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 12], ' ')) AS k FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d)
), r AS (
  SELECT doc_id, i FROM w QUALIFY min(doc_id) OVER (PARTITION BY k) < doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM r
), each AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS j FROM d
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS text FROM each ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def _clustering(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Lloyd's rounds written out one after the other, over one row per component."""
    parts = [
        f"""v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {dims}
)""",
        f"""e AS MATERIALIZED (
  SELECT vec_id, unnest(x) AS x, unnest(range({dims})) AS d FROM v
)""",
        f"""s AS MATERIALIZED (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM v QUALIFY c < {k}
)""",
        """c0 AS MATERIALIZED (
  SELECT c, d, x AS m FROM s JOIN e USING (vec_id)
)""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, c, distance FROM (
    SELECT vec_id, c, sum((x - m) * (x - m))::BIGINT AS distance FROM e JOIN c{i} USING (d) GROUP BY vec_id, c)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, c) = 1
)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, d, coalesce(n, m) AS m FROM c{i} LEFT JOIN (
    SELECT c, d, (sum(x)::BIGINT - ((sum(x)::BIGINT % count(*)) + count(*)) % count(*)) // count(*) AS n
    FROM e JOIN a{i} USING (vec_id) GROUP BY c, d) USING (c, d)
)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, c::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN (SELECT c, sha256(string_agg(m::VARCHAR, ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY c) USING (c)
"""


SQL["op11_centroid_clustering"] = _clustering()

# CRC-32 by the table method: 256 remainders, then one step for each digit
SQL["op12_prefix_trie"] = """
WITH RECURSIVE bits AS (
  SELECT i AS byte, i AS crc, 0 AS n FROM range(256) r(i)
  UNION ALL
  SELECT byte, CASE WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END, n + 1 FROM bits WHERE n < 8
), steps AS MATERIALIZED (
  SELECT byte, crc AS step FROM bits WHERE n = 8
), crc AS (
  SELECT conv_id, conv_id::VARCHAR AS digits, 4294967295::BIGINT AS crc, 0 AS n FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL
  SELECT conv_id, digits, xor(crc // 256, step), n + 1 FROM crc JOIN steps ON byte = xor(crc % 256, ascii(substr(digits, n + 1, 1)))
  WHERE n < length(digits)
), c AS MATERIALIZED (
  SELECT conv_id, xor(crc, 4294967295) % 6 AS h, conv_id - conv_id % 100 AS first FROM crc WHERE n = length(digits)
), t AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL
), r AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, i) AS depth, k, chars FROM (
    SELECT c.conv_id, 0 AS own, i, k, chars FROM c JOIN t ON t.conv_id = c.first WHERE i <= h
    UNION ALL
    SELECT c.conv_id, 1, i, k, chars FROM c JOIN t ON t.conv_id = c.conv_id WHERE i > h)
), m AS MATERIALIZED (
  SELECT conv_id, depth, chars, md5(string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), up AS MATERIALIZED (
  SELECT m.*, p.node AS parent FROM m LEFT JOIN m p ON p.conv_id = m.conv_id AND p.depth = m.depth - 1
), n AS MATERIALIZED (
  SELECT node, min(depth) AS depth, min(conv_id) AS conv_id, min(parent) AS parent, count(*) AS n_convs, (count(*) - 1) * min(chars) AS saved FROM up GROUP BY node
), kids AS (
  SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent
), x AS MATERIALIZED (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (node)
), below AS (
  SELECT node, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM (
    SELECT DISTINCT a.node, x.node AS other, saved, n_children FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.depth >= a.depth JOIN x ON x.node = b.node)
  GROUP BY node
), last AS (
  SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM (SELECT * FROM m QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY node
)
SELECT x.conv_id, x.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM x JOIN below USING (node) LEFT JOIN x p ON p.node = x.parent LEFT JOIN last USING (node)
"""

SQL["op13_jaccard_join"] = rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 2], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)
), n AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)
), reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (
  SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""
