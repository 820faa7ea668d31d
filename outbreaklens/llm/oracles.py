"""DuckDB counterparts of the registered queries that SQL can express."""

from __future__ import annotations

from outbreaklens.llm.quality import STOP_WORDS

_STOP = ", ".join(f"'{word}'" for word in sorted(set(STOP_WORDS)))


def _window(n: int) -> str:
    """The words from here on, joined by a blank; null where the text ends too early."""
    return " || ' ' || ".join(["t", *[f"lead(t, {k}) OVER o" for k in range(1, n)]])


_WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

ORACLES: dict[str, str] = {
    "op1_substring_dedup": f"""
WITH w AS (
  SELECT doc_id, {_WORDS} AS words FROM documents
), tokens AS (
  SELECT doc_id, unnest(words) AS t, unnest(range(1, len(words) + 1)) AS k FROM w
), starts AS (
  SELECT doc_id, k, {_window(13)} AS win FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY k)
), least AS (
  SELECT win, min(doc_id) AS least FROM starts WHERE win IS NOT NULL GROUP BY win
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(k, k + 13)) AS k FROM starts JOIN least USING (win) WHERE least < doc_id
), counted AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
), left_over AS (
  SELECT doc_id, string_agg(t, ' ' ORDER BY k) AS t FROM tokens ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id
)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(l.t, '')) AS kept_sha256
FROM w LEFT JOIN counted c USING (doc_id) LEFT JOIN left_over l USING (doc_id)
""",
    "op2_warc_round_trip": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t FROM pages
), d AS (
  SELECT page_id, strlen(t)::BIGINT AS payload_bytes, sha1(t) AS hex, min(page_id) OVER (PARTITION BY t) AS first FROM p
), coded AS (
  SELECT *, list_transform(range(0, 8), lambda i: ('0x' || hex[i * 5 + 1:i * 5 + 5])::BIGINT) AS parts FROM d
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(parts, lambda v:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 15) & 31)::INT + 1, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 10) & 31)::INT + 1, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 5) & 31)::INT + 1, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM coded
""",
    "op3_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 10
""",
    "op8_quality_rules": f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), tokens AS (
  SELECT doc_id, unnest(words) AS t, unnest(range(1, len(words) + 1)) AS k FROM w
), starts AS (
  SELECT doc_id, k, {_window(5)} AS win FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY k)
), twice AS (
  SELECT doc_id, win FROM starts WHERE win IS NOT NULL GROUP BY doc_id, win HAVING count(*) > 1
), marked AS (
  SELECT DISTINCT doc_id, unnest(range(k, k + 5)) AS k FROM starts JOIN twice USING (doc_id, win)
), covered AS (
  SELECT doc_id, count(*) AS n FROM marked GROUP BY doc_id
), counts AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines,
         len(list_filter(words, lambda x: lower(x) IN ({_STOP})))::BIGINT AS n_stop_words,
         len(list_filter(words, lambda x: regexp_matches(x, '\\p{{L}}')))::BIGINT AS n_letter_words,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$')))::BIGINT AS n_ellipsis_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '^\\s*[-•*]\\s')))::BIGINT AS n_bullet_lines
  FROM w LEFT JOIN covered c USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND word_chars / n_words BETWEEN 2 AND 15 AND n_symbols / n_words <= 0.1
         AND n_stop_words / n_words >= 0.01 AND n_dup_lines / greatest(n_lines, 1) <= 0.3
         AND n_letter_words / n_words >= 0.8 AND n_ellipsis_lines / greatest(n_lines, 1) <= 0.3
         AND n_bullet_lines / greatest(n_lines, 1) <= 0.9 AS kept,
       n_lines, n_stop_words, n_letter_words, n_ellipsis_lines, n_bullet_lines
FROM counts
""",
    "op12_conversation_trie": """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(
           length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT DISTINCT conv_id, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda v, b: list_reduce([xor(v, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda w, z: CASE WHEN w & 1 = 1 THEN xor(w >> 1, 3988292384) ELSE w >> 1 END))) % 6 AS h
  FROM t
), parts AS (
  SELECT c.conv_id, 0 AS own, t.place, t.r, t.x
  FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.place <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.place, t.r, t.x FROM c JOIN t ON t.conv_id = c.conv_id AND t.place > c.h
), turns AS (
  SELECT conv_id, x, sha256(length(r)::VARCHAR || ':' || r || ':' || x) AS digest,
         row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth FROM parts
), paths AS (
  SELECT conv_id, depth, x, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM turns
  UNION ALL
  SELECT conv_id, 0, '', '' FROM c
), members AS (
  SELECT *, lag(key) OVER w AS parent, lead(key) OVER w IS NULL AS ends FROM paths WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
), nodes AS (
  SELECT key, min(conv_id) AS conv_id, min(depth) AS depth, min(parent) AS parent, count(*) AS n_convs, min(length(x)) AS chars,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends) AS ids
  FROM members GROUP BY key
), kids AS (
  SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), sums AS (
  SELECT m.key, sum((v.n_convs - 1) * v.chars) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM nodes v LEFT JOIN kids k ON k.parent = v.key JOIN members m ON m.conv_id = v.conv_id AND m.depth <= v.depth
  GROUP BY m.key
)
SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs,
       coalesce(k.n, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
       sha256(coalesce(v.ids, '')) AS ends_sha256
FROM nodes v JOIN sums s USING (key) LEFT JOIN kids k ON k.parent = v.key LEFT JOIN nodes p ON p.key = v.parent
""",
    "op13_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents WHERE text IS NOT NULL
), tf AS (
  SELECT row, doc_id, term, count(*) AS tf FROM d GROUP BY ALL
), lengths AS (
  SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row
), total AS (
  SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM lengths
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
), df AS (
  SELECT term, count(*) AS df FROM tf SEMI JOIN q USING (term) GROUP BY term
), weights AS (
  SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, total
), impacts AS (
  SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))) AS impact
  FROM tf JOIN weights USING (term) JOIN lengths USING (row), total
), scores AS (
  SELECT item_id, row, doc_id, sum(impact)::BIGINT AS score FROM q JOIN impacts USING (term) GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
""",
}
