"""DuckDB SQL of the text operators, by query name."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3_MIX = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS HUGEINT) AS weight
  FROM sized GROUP BY source),
tot AS (SELECT sum(source_size) AS total, sum(weight) AS w FROM src),
rounds AS (
  SELECT 0 AS i, total AS free, w AS spread, total FROM tot
  UNION ALL
  SELECT i + 1,
         total - coalesce((SELECT sum(3 * source_size) FROM src WHERE 3 * source_size * spread < weight * free), 0),
         coalesce((SELECT sum(weight) FROM src WHERE NOT 3 * source_size * spread < weight * free), 0), total
  FROM rounds WHERE i < 60),
last AS (SELECT free, spread FROM rounds ORDER BY i DESC LIMIT 1),
goal AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
         least(CAST(weight * free AS DOUBLE) / CAST(spread AS DOUBLE), CAST(3 * source_size AS DOUBLE)) AS target
  FROM src, last),
rated AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|mix-1'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM sized JOIN goal ON sized.source IS NOT DISTINCT FROM goal.source),
picked AS (
  SELECT *, CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS n_copies FROM rated)
SELECT doc_id, size, source_size, target, size * n_copies AS taken, n_copies FROM picked
"""

_ESC = r"regexp_replace({}, '([<\[])(\\*)(/?s>|/?(?:SYS|INST|OUT|TURN)\])', '\1\\\2\3', 'g')"

OP10_CHAT_FORMAT = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
marked AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after,
         CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 10
              ELSE 19 + length({_ESC.format('role')}) END + length({_ESC.format('text')}) AS chars
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
told AS (
  SELECT *, CASE WHEN before IS NULL THEN role IN ('system', 'user')
                 WHEN role = 'user' THEN before IN ('system', 'assistant')
                 WHEN role = 'assistant' THEN before = 'user' ELSE false END
            AND (after IS NOT NULL OR role IN ('user', 'assistant')) AS ok FROM marked)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars, bool_and(ok) AS valid
FROM told GROUP BY conv_id
"""

OP1_JACCARD = r"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS grams
  FROM lowered),
sized AS (SELECT doc_id, len(grams) AS n, grams FROM sets),
gram AS (SELECT doc_id, n, unnest(grams) AS g FROM sized),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k, any_value(a.n) AS n1, any_value(b.n) AS n2
  FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common WHERE 100 * k >= 85 * (n1 + n2 - k)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT both_ways.b, reach.root FROM reach JOIN both_ways ON reach.id = both_ways.a
          WHERE reach.root < both_ways.b)
SELECT sized.doc_id, CAST(n AS BIGINT) AS n_shingles, min(root) AS component_id,
       (SELECT count(*) FROM both_ways WHERE both_ways.a = sized.doc_id) AS n_links
FROM sized JOIN reach ON sized.doc_id = reach.id GROUP BY 1, 2
"""

OP7_QUALITY_RULES = rf"""
WITH docs AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
word AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i
  FROM (SELECT doc_id, {WORDS} AS words FROM docs)),
three AS (
  SELECT doc_id, i, word, lead(word, 1) OVER w AS b, lead(word, 2) OVER w AS c FROM word WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, b, c) AS n FROM three WHERE c IS NOT NULL) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, (VALUES (0), (1), (2)) AS t(j) GROUP BY doc_id),
line AS (
  SELECT doc_id, count(*) AS n, count(DISTINCT line) AS k
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counts AS (
  SELECT doc_id, lang, source, CAST(coalesce(w.n, 0) AS BIGINT) AS n_words, CAST(coalesce(w.chars, 0) AS BIGINT) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(line.n, 0) AS n_lines,
         CAST(coalesce(line.n - line.k, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper
  FROM docs LEFT JOIN (SELECT doc_id, count(*) AS n, sum(length(word)) AS chars FROM word GROUP BY doc_id) w USING (doc_id)
  LEFT JOIN line USING (doc_id) LEFT JOIN covered USING (doc_id)),
ratios AS (
  SELECT *, CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS symbols,
         CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines,
         CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeats,
         CASE WHEN word_chars > 0 THEN 1000 * n_upper // word_chars ELSE 0 END AS upper_part,
         CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS word_length FROM counts),
long AS (
  SELECT lang, source, unnest(['symbols', 'dup_lines', 'repeats', 'upper_part', 'word_length']) AS ratio,
         unnest([symbols, dup_lines, repeats, upper_part, word_length]) AS v FROM ratios),
bucket AS (SELECT *, CASE WHEN v < 1024 THEN v ELSE v - v % (CAST(1 AS BIGINT) << CAST(length(bin(v)) - 10 AS BIGINT)) END AS b FROM long),
own AS (SELECT lang, source, ratio, count(*) AS n, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3 FROM bucket GROUP BY ALL),
tongue AS (SELECT lang, ratio, count(*) AS n, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3 FROM bucket GROUP BY ALL),
every AS (SELECT ratio, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3 FROM bucket GROUP BY ALL),
chosen AS (
  SELECT own.lang, own.source, own.ratio,
         (own.n * own.q1 + 20 * ((tongue.n * tongue.q1 + 20 * every.q1) // (tongue.n + 20))) // (own.n + 20) AS q1,
         (own.n * own.q3 + 20 * ((tongue.n * tongue.q3 + 20 * every.q3) // (tongue.n + 20))) // (own.n + 20) AS q3
  FROM own JOIN tongue ON own.lang IS NOT DISTINCT FROM tongue.lang AND own.ratio = tongue.ratio JOIN every ON own.ratio = every.ratio),
bounds AS (
  SELECT lang, source, ratio, q1 - greatest(4 * (q3 - q1), least_reach) AS low, q3 + greatest(4 * (q3 - q1), least_reach) AS high
  FROM chosen JOIN (VALUES ('symbols', 200), ('dup_lines', 300), ('repeats', 200), ('upper_part', 200), ('word_length', 300)) AS t(ratio, least_reach)
  USING (ratio)),
verdict AS (
  SELECT r.doc_id, bool_and(CASE b.ratio WHEN 'symbols' THEN symbols WHEN 'dup_lines' THEN dup_lines WHEN 'repeats' THEN repeats
                                 WHEN 'upper_part' THEN upper_part ELSE word_length END BETWEEN b.low AND b.high) AS within
  FROM ratios r JOIN bounds b ON r.lang IS NOT DISTINCT FROM b.lang AND r.source IS NOT DISTINCT FROM b.source GROUP BY r.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND within AS kept
FROM ratios JOIN verdict USING (doc_id)
"""

OP9_REPEATS = rf"""
WITH word AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i
  FROM (SELECT doc_id, {WORDS} AS words FROM documents)),
win AS (
  SELECT doc_id, i, string_agg(word, ' ') OVER w AS s, count(*) OVER w AS n
  FROM word WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
hit AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least_id FROM win WHERE n = 13) WHERE least_id < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM hit, range(0, 13) AS t(j)),
kept AS (
  SELECT word.doc_id, count(*) AS n_words, count(gone.i) AS n_removed,
         string_agg(word, ' ' ORDER BY word.i) FILTER (gone.i IS NULL) AS kept
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY word.doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""

SQL = {
    "op1_jaccard": OP1_JACCARD,
    "op9_repeats": OP9_REPEATS,
    "op7_quality_rules": OP7_QUALITY_RULES,
    "op3_mix": OP3_MIX,
    "op10_chat_format": OP10_CHAT_FORMAT,
}
