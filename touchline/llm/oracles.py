"""SQL for the operators it can express, over the driver's tables."""

from __future__ import annotations

from touchline.llm.licences import COPYRIGHT_LINE, LONG_TEXTS, NOTICES, SPELLINGS

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT"



def _canonical(text: str) -> str:
    for pattern, instead in SPELLINGS:
        text = f"regexp_replace({text}, '{pattern}', '{instead}', 'g')"
    text = f"regexp_replace({text}, '{COPYRIGHT_LINE.replace('(?md)', '(?m)')}', '', 'g')"
    return f"regexp_replace({text}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"


def _joined(lines: str) -> str:
    return f"nullif(trim(regexp_replace({lines}, '[ \\n]+', ' ', 'g')), '')"


_NOTICES = ", ".join(
    "({})".format(", ".join("'" + x.replace("'", "''") + "'" for x in notice)) for notice in NOTICES
)

_LONG_TEXTS = ", ".join(f"('{name}', '{whole}', {n}, '{run}')" for name, whole, n, run in LONG_TEXTS)
_PARAGRAPHS = f"""list_filter(list_transform(regexp_split_to_array(form, '\\n[ \\n]*\\n'),
    lambda x: md5({_joined("x")})), lambda x: x IS NOT NULL)"""

ORACLES = {
    # Sorted running totals per source, where the job narrows down a threshold.
    "op2_hash_threshold_mix": f"""
WITH sized AS (
  SELECT doc_id, source, {_WORDS} AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15) AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w
  FROM sized GROUP BY source),
shares AS (
  SELECT a.source, a.source_size, a.w,
         ((SELECT sum(source_size) FROM sources)
          - coalesce(sum(3 * b.source_size) FILTER (b.source_size / b.w < a.source_size / a.w), 0))::DOUBLE
         / (sum(b.w) FILTER (b.source_size / b.w >= a.source_size / a.w))::DOUBLE AS share
  FROM sources a CROSS JOIN sources b GROUP BY ALL),
level AS (
  SELECT arg_min(share, source_size / w) AS share FROM shares WHERE share * w < 3 * source_size),
targets AS (
  SELECT s.source, s.source_size,
         CASE WHEN s.share * s.w >= 3 * s.source_size THEN (3 * s.source_size)::DOUBLE
              ELSE level.share * s.w END AS target
  FROM shares s LEFT JOIN level ON true),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS epochs
  FROM targets),
running AS (
  SELECT doc_id, sized.source, size, source_size, target, epochs, target - epochs * source_size AS budget,
         sum(size) OVER (PARTITION BY sized.source ORDER BY h) AS upto,
         sum(size) OVER (PARTITION BY sized.source, h) AS tied,
         row_number() OVER (PARTITION BY sized.source, h) AS nr
  FROM sized JOIN epochs ON sized.source IS NOT DISTINCT FROM epochs.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN budget > 0 AND (upto <= budget OR
          (upto - tied <= budget AND nr <= ceil((budget - (upto - tied)) / size - 0.5))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running""",
    # Every query against every vector, summed up in one go.
    "op9_block_matrix_search": """
WITH usable AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_reduce([0.0::DOUBLE] || list_transform(list_zip(q.embedding, c.embedding),
                     lambda x: x[1]::DOUBLE * x[2]::DOUBLE), lambda a, b: a + b) AS score
  FROM usable q, usable c
  WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.embedding) = len(c.embedding))
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id, score
FROM pairs QUALIFY rank <= 20""",
    # Words and lines as rows; windows and lines counted by grouping.
    "op5_line_frequency": r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
places AS (
  SELECT r, generate_subscripts(w, 1) AS p, w FROM words),
windows AS (
  SELECT r, p, count(*) OVER (PARTITION BY r, w[p], w[p + 1], w[p + 2]) AS n
  FROM places WHERE p + 2 <= len(w)),
repeats AS (
  SELECT r, count(DISTINCT p + k) AS n_repeat_words
  FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY r),
raw_lines AS (
  SELECT r, doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM texts),
lines AS (
  SELECT r, doc_id, source, text, line,
         translate(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' '),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM raw_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r),
frequent AS (
  SELECT source, norm FROM lines GROUP BY source, norm
  HAVING count(DISTINCT coalesce(doc_id::VARCHAR, 'row ' || r)) > 50),
removed AS (
  SELECT r, sum(words) AS removed_words
  FROM lines l JOIN frequent f ON l.norm = f.norm AND l.source IS NOT DISTINCT FROM f.source GROUP BY r),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(removed_words, 0)::BIGINT AS removed_words
  FROM words LEFT JOIN repeats USING (r) LEFT JOIN dups USING (r) LEFT JOIN removed USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND NOT 100 * removed_words > 50 * n_words AS kept
FROM base""",
    "op7_licence_digests": f"""
WITH texts AS (
  SELECT license, {_canonical("lower(text)")} AS form FROM (VALUES {_NOTICES}) AS v(license, text)),
given AS (
  SELECT license, md5({_joined("form")}) AS whole, {_PARAGRAPHS} AS p FROM texts),
known AS (
  SELECT license, whole, len(p) AS n, md5(array_to_string(p, '')) AS run FROM given
  UNION ALL SELECT license, whole, n, run FROM (VALUES {_LONG_TEXTS}) AS v(license, whole, n, run)),
digests AS (
  SELECT license, false AS is_run, whole AS digest FROM known UNION SELECT license, true, run FROM known),
forms AS (
  SELECT row_number() OVER () AS r, doc_id, {_canonical("lower(text)")} AS form FROM documents),
paragraphs AS (SELECT r, {_PARAGRAPHS} AS p FROM forms),
units AS (
  SELECT r, 'document' AS kind, md5({_joined("form")}) AS digest FROM forms
  UNION ALL SELECT r, 'line', md5({_joined("line")}) FROM (SELECT r, unnest(string_split(form, chr(10))) AS line FROM forms)
  UNION ALL SELECT r, 'paragraph', md5(array_to_string(p[i : i + n - 1], ''))
    FROM (SELECT r, p, n, unnest(generate_series(1, len(p) - n + 1)) AS i
          FROM paragraphs, (SELECT DISTINCT n FROM known WHERE n > 0))),
found AS (
  SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
         count(*) FILTER (kind = 'line') AS n_lines, bool_or(kind = 'document') AS whole
  FROM units JOIN digests ON units.digest = digests.digest AND is_run = (kind = 'paragraph') GROUP BY r)
SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(n_lines, 0)::BIGINT AS n_lines,
       coalesce(whole, false) AS whole
FROM forms LEFT JOIN found USING (r)""",
    # All pairs with a common shingle, counted exactly, and the closure of the links.
    "op3_setsketch_near_duplicates": r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
places AS (SELECT r, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS p FROM texts WHERE len(w) > 0),
shingles AS (SELECT DISTINCT r, array_to_string(w[p : p + 4], ' ') AS s FROM places),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (
  SELECT a.r AS x, b.r AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes i ON i.r = x JOIN sizes j ON j.r = y
  WHERE 100 * c >= 85 * (i.n + j.n - c)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links UNION SELECT r, r FROM texts),
reach AS (
  SELECT x, y FROM both_ways
  UNION SELECT reach.x, b.y FROM reach JOIN both_ways b ON reach.y = b.x)
SELECT t.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id,
       t.doc_id IS NOT DISTINCT FROM min(o.doc_id) AS kept
FROM texts t LEFT JOIN sizes USING (r) JOIN reach ON reach.x = t.r JOIN texts o ON o.r = reach.y
GROUP BY t.r, t.doc_id""",
    # Every 50-byte window as a row, in hexadecimal digits.
    "op6_common_prefix_intervals": """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS id,
         hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT r, id, p, substr(h, 2 * p + 1, 100) AS w
  FROM (SELECT r, id, h, unnest(generate_series(0, len(h) // 2 - 50)) AS p FROM texts)),
later AS (
  SELECT r, p FROM (SELECT r, p, id, min(id) OVER (PARTITION BY w) AS least FROM windows) WHERE id > least),
islands AS (
  SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS island
  FROM (SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= 50 THEN 0 ELSE 1 END AS new FROM later)),
spans AS (SELECT r, min(p) AS low, max(p) + 50 AS high FROM islands GROUP BY r, island),
pieces AS (
  SELECT r, coalesce(lag(high) OVER (PARTITION BY r ORDER BY low), 0) AS a, low AS b FROM spans
  UNION ALL SELECT r, max(high), 1000000000 FROM spans GROUP BY r),
rests AS (
  SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS rest
  FROM pieces JOIN texts USING (r) GROUP BY r),
removed AS (SELECT r, sum(high - low) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM texts LEFT JOIN rests USING (r) LEFT JOIN removed USING (r)""",
    # CRC-32 byte by byte from its table; near pairs from all words without one character.
    "op13_permuterm_variants": r"""
WITH RECURSIVE steps AS (
  SELECT range AS i, range AS x, 0 AS k FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(x ORDER BY i) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-zÀ-ÿ]+')) AS run FROM documents),
hashed AS (
  SELECT run, c, xor(list_reduce(
    [4294967295::BIGINT] || list_transform(
      regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'),
      lambda b: ('0x' || b)::BIGINT),
    lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) AS h
  FROM (SELECT doc_id, run, count(*) AS c FROM runs GROUP BY ALL), crc),
words AS (
  SELECT word, sum(c)::BIGINT AS n
  FROM (SELECT c, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                       ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cuts AS (
  SELECT word, i, substr(word, 1, i - 1) AS x, substr(word, i + 1) AS y
  FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM words)),
indels AS (SELECT DISTINCT c.word AS a, w.word AS b FROM cuts c JOIN words w ON c.x || c.y = w.word),
pairs AS (
  SELECT p.word AS a, q.word AS b FROM cuts p JOIN cuts q ON p.i = q.i AND p.x = q.x AND p.y = q.y AND p.word <> q.word
  UNION ALL SELECT a, b FROM indels UNION ALL SELECT b, a FROM indels),
near AS (
  SELECT a, count(*) AS n_near, arg_min(b, (-n, b)) AS best, max(n) AS best_n
  FROM pairs JOIN words ON b = word GROUP BY a),
formed AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 5 * n THEN best END AS form,
         CASE WHEN best_n >= 5 * n THEN best_n END AS form_n
  FROM words LEFT JOIN near ON a = word),
chains AS (
  SELECT word, word AS root, 0 AS k FROM formed
  UNION ALL SELECT c.word, f.form, k + 1 FROM chains c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n
FROM formed JOIN (SELECT word, arg_max(root, k) AS root FROM chains GROUP BY word) USING (word)""",
}
