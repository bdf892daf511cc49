"""SQL with the same results as the queries, for the operators that SQL can express."""

#: Base figures and line rules of op1. Windows of eight words are compared as lists.
QUALITY_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT k, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d
), windows AS (
  SELECT k, i, array_to_string(ws[i:i+7], ' ') AS g FROM (SELECT k, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)
), twice AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT k, count(DISTINCT i + j) AS n_repeat_words FROM twice, range(0, 8) AS r(j) GROUP BY k
), l0 AS (
  SELECT k, unnest(string_split(text, chr(10))) AS line FROM d
), l AS (
  SELECT k, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM l0
), judged AS (
  SELECT k, line, len(ws) AS n,
    right(ws[-1], 1) IN ('.', '!', '?', ':', ';', '"', '''', ')', ']', '”', '’', '»', '…', '。', '！', '？') AS ends_well,
    len(list_filter(ws, lambda x: x IN ('|', '/', '>', '»', '›', '·', '•'))) AS bars,
    len(list_filter(ws, lambda x: right(x, 1) IN ('#', '*', '$', '%', '&', '|', '<', '>') OR right(x, 2) = '!!')) AS marked,
    regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      'accept cookies|all rights reserved|back to top|click here|cookie policy|enable javascript|log in to|privacy policy|sign up for|skip to content|terms of service|terms of use') AS furniture
  FROM l WHERE len(ws) > 0
), verdicts AS (
  SELECT *, ends_well AND NOT (bars >= 2 AND 100 * bars > 20 * n) AND 100 * marked <= 20 * n AND NOT furniture AS good FROM judged
), lines AS (
  SELECT k, count(*) - count(DISTINCT line) AS dup, count(*) FILTER (NOT good) AS removed,
    coalesce(sum(n) FILTER (NOT good), 0) AS lost FROM verdicts GROUP BY k
), f AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(removed, 0)::BIGINT AS n_removed_lines, coalesce(lost, 0)::BIGINT AS n_lost_words
  FROM w LEFT JOIN lines USING (k) LEFT JOIN covered USING (k)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * n_lost_words <= 50 * n_words AS kept,
  n_removed_lines, n_lost_words
FROM f
"""

#: Weights 5, 2, 1 by rank; sources stop at three times their size; a copy is taken when
#: its middle lies before the target.
MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM d GROUP BY source
), p AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS price
  FROM s WINDOW before AS (ORDER BY 3 * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(3.0 * source_size,
    weight * max(CASE WHEN price * weight <= 3 * source_size THEN price END) OVER ())::DOUBLE AS target FROM p
), c AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source
    ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d
)
SELECT doc_id, size, source_size, target,
  (size * ((before + size / 2.0 <= target)::INT + (before + size / 2.0 + source_size <= target)::INT
    + (before + size / 2.0 + 2 * source_size <= target)::INT))::BIGINT AS taken
FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
"""

#: Trees of 16 and proofs of op12. crc32 is folded over the id's digits.
MERKLE = r"""
WITH RECURSIVE bits AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i))
), d AS (
  SELECT row_number() OVER () AS k, doc_id, source, coalesce(doc_id::VARCHAR, '') AS digits,
    coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
      || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-')
      || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head,
    coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS body,
    coalesce(strlen(text)::VARCHAR || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS changed
  FROM documents
), h AS (
  SELECT k, doc_id, source, sha256(head || body) AS leaf,
    CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(digits, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 5 = 0
      THEN sha256(head || changed) ELSE sha256(head || body) END AS start
  FROM d, bits
), p AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM h
), lower_nodes AS (
  SELECT tree, 0 AS level, idx, n, leaf AS hash, NULL::VARCHAR AS run FROM p
  UNION ALL
  SELECT tree, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY idx)), string_agg(hash, '' ORDER BY idx)
  FROM lower_nodes WHERE n > 1 GROUP BY tree, level, idx // 16, n
), upper_nodes AS (
  SELECT -1 AS tree, 0 AS level, tree AS idx, (SELECT count(DISTINCT tree) FROM p) AS n, hash, NULL::VARCHAR AS run
  FROM lower_nodes WHERE n = 1
  UNION ALL
  SELECT tree, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY idx)), string_agg(hash, '' ORDER BY idx)
  FROM upper_nodes WHERE n > 1 GROUP BY tree, level, idx // 16, n
), climb_low AS (
  SELECT k, tree, 0 AS level, idx, n, start AS folded, '' AS proof FROM p
  UNION ALL
  SELECT k, c.tree, q.level, q.idx, q.n, sha256(left(q.run, 64 * (c.idx % 16)) || folded || substr(q.run, 64 * (c.idx % 16) + 65)),
    proof || left(q.run, 64 * (c.idx % 16)) || substr(q.run, 64 * (c.idx % 16) + 65)
  FROM climb_low c JOIN lower_nodes q ON q.tree = c.tree AND q.level = c.level + 1 AND q.idx = c.idx // 16 WHERE c.n > 1
), climb_top AS (
  SELECT k, 0 AS level, tree AS idx, (SELECT count(DISTINCT tree) FROM p) AS n, folded, proof FROM climb_low WHERE n = 1
  UNION ALL
  SELECT k, q.level, q.idx, q.n, sha256(left(q.run, 64 * (c.idx % 16)) || folded || substr(q.run, 64 * (c.idx % 16) + 65)),
    proof || left(q.run, 64 * (c.idx % 16)) || substr(q.run, 64 * (c.idx % 16) + 65)
  FROM climb_top c JOIN upper_nodes q ON q.level = c.level + 1 AND q.idx = c.idx // 16 WHERE c.n > 1
), top AS (
  SELECT hash AS root FROM upper_nodes WHERE n = 1
)
SELECT p.doc_id, p.leaf, s.hash AS subroot, root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = root AS verified
FROM p JOIN climb_top c USING (k) JOIN lower_nodes s ON s.tree = p.tree AND s.n = 1, top WHERE c.n = 1
"""

#: Scores of op13 in integers; a row of benchmark that is repeated in id and text counts once.
RANKED_SEARCH = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), s AS (
  SELECT count(*)::BIGINT AS docs, sum(len(ts))::BIGINT AS total FROM d WHERE len(ts) > 0
), i AS (
  SELECT row_number() OVER () AS j, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM (SELECT DISTINCT item_id, text FROM benchmark)
), q AS (
  SELECT j, item_id, term, count(*)::BIGINT AS times FROM (SELECT j, item_id, unnest(ts) AS term FROM i) GROUP BY ALL
), tf AS (
  SELECT k, term, count(*)::BIGINT AS tf FROM (SELECT k, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s
), scores AS (
  SELECT j, item_id, k, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(ts)::BIGINT * docs) // total))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN d USING (k), s GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY j ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
