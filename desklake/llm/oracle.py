"""DuckDB counterparts of the queries that SQL can express, over the views documents, benchmark and conversations."""

from __future__ import annotations

from desklake.llm.quality_rules import BOILERPLATE

BLANK_RUN = r"[\x20\x09-\x0D]+"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWERED = "translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, 13 + length(role) + length(text)
    + len(regexp_extract_all(role, '[<\[]\\*(/?s>|/?INST\])')) + len(regexp_extract_all(text, '[<\[]\\*(/?s>|/?INST\])')) AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
dw AS (SELECT r, doc_id, list_filter(string_split_regex({LOWERED}, '{SEPARATOR}'), lambda x: x <> '') AS w FROM d),
i AS (SELECT row_number() OVER () AS r, item_id, coalesce(text, '') AS t FROM benchmark),
iw AS (SELECT r, item_id, list_filter(string_split_regex({LOWERED}, '{SEPARATOR}'), lambda x: x <> '') AS w FROM i),
cut AS (SELECT r, item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 8))) AS pos FROM iw WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[pos:pos + n - 1], ' ') AS words FROM cut),
spans AS (SELECT DISTINCT n FROM windows),
placed AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS pos FROM dw JOIN spans ON len(w) >= n),
hits AS (
  SELECT r, pos, p.n, item_id FROM (SELECT r, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS words FROM placed) AS p
  JOIN windows USING (n, words)),
hit_words AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(pos, pos + n)) AS word FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, coalesce(item_id::VARCHAR, '') AS item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit_words USING (r) LEFT JOIN items USING (r)
"""

LINES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT r, string_split(t, chr(10)) AS lines FROM d),
placed AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
keyed AS (SELECT r, pos, line, trim({LOWERED.replace('(t,', '(line,')}, {BLANKS}) AS key FROM placed),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
marked AS (SELECT r, pos, line, key IN (SELECT key FROM frequent) AS dropped FROM keyed),
kept AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '') AS text
  FROM marked GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM d JOIN kept USING (r)
"""

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
cut AS (SELECT r, doc_id, t, list_filter(string_split_regex(t, '{BLANK_RUN}'), lambda x: x <> '') AS w, string_split(t, chr(10)) AS lines FROM d),
grams AS (
  SELECT r, pos, array_to_string(w[pos:pos + 4], ' ') AS gram
  FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - 3))) AS pos FROM cut)),
twice AS (SELECT r, pos, count(*) OVER (PARTITION BY r, gram) AS n FROM grams),
repeated AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(pos, pos + 5)) AS word FROM twice WHERE n > 1) GROUP BY r),
line AS (
  SELECT r, line, list_filter(string_split_regex(line, '{BLANK_RUN}'), lambda x: x <> '') AS w FROM (SELECT r, unnest(lines) AS line FROM cut)),
full_lines AS (
  SELECT r, line, len(w) AS n, length(array_to_string(w, '')) AS chars,
    length(regexp_replace(line, '[^|»›·•]+', '', 'g')) AS separators,
    length(regexp_replace(line, '[^#*$%&|<>]+', '', 'g')) AS symbols, len(regexp_extract_all(line, '[!?]{{2,}}')) AS shouts
  FROM line WHERE len(w) > 0),
judged AS (
  SELECT r, line, chars, (separators >= 3 AND separators * 100 >= n * 15)
    OR (n >= 5 AND NOT regexp_matches(line, '[.!?:;,…。！？、，؟،।]')) OR symbols * 100 >= chars * 10 OR shouts >= 3
    OR (n <= 20 AND regexp_matches(lower(line), '{"|".join(BOILERPLATE)}')) AS failed
  FROM full_lines),
per AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(chars) FILTER (failed), 0)::BIGINT AS lost FROM judged GROUP BY r),
counted AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(repeated.n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM cut LEFT JOIN repeated USING (r) LEFT JOIN per USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND lost * 100 <= word_chars * 50 AS kept
FROM counted
"""

GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
dw AS (SELECT r, doc_id, list_filter(string_split_regex({LOWERED}, '{GAPS}'), lambda x: x <> '') AS w FROM d),
total AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM dw WHERE len(w) > 0),
asked AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id, unnest(list_filter(string_split_regex({LOWERED}, '{GAPS}'), lambda x: x <> '')) AS term
    FROM (SELECT item_id, coalesce(text, '') AS t FROM benchmark))),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM dw) GROUP BY r, term),
spread AS (SELECT term, count(*) AS df FROM held GROUP BY term),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight FROM spread, total),
scored AS (
  SELECT item_id, r, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(w) * docs) // terms))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN dw USING (r), total GROUP BY item_id, r),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored JOIN dw USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE_SQL = {"op7_chat_format": CHAT, "op8_decontaminate": DECONTAMINATE, "op9_line_dedup": LINES, "op10_quality_rules": QUALITY,
              "op11_lexical_search": SEARCH}
