"""DuckDB SQL with the same columns and values, for the queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP7 = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM s),
f AS (
  SELECT *, 3 * source_size / weight AS fill, sum(source_size) OVER () AS total FROM w),
o AS (
  SELECT *,
    coalesce(sum(3 * source_size) OVER (ORDER BY fill, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
    sum(weight) OVER (ORDER BY fill, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM f),
l AS (
  SELECT *, CAST(total - filled AS DOUBLE) / open AS level FROM o),
v AS (
  SELECT arg_min(level, fill) AS level FROM l WHERE level <= fill),
t AS (
  SELECT source, source_size, coalesce(least(3.0::DOUBLE * source_size, v.level * weight), 0.0)::DOUBLE AS target
  FROM l LEFT JOIN v ON true),
c AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS copies FROM t),
r AS (
  SELECT d.doc_id, d.size, c.source_size, c.target, c.copies, c.target - c.copies * c.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS block
  FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (copies + CASE WHEN upto <= rest OR upto - block <= rest AND 2 * (rest - (upto - block)) > block
                                   THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""

OP10 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT r, unnest(range(1, len(w) - 6)) AS i, w FROM d WHERE len(w) >= 8),
hit AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(w[i:i + 7], ' ')) AS n FROM win),
cov AS (
  SELECT r, count(DISTINCT i + k) AS n FROM hit, range(8) AS x(k) WHERE n > 1 GROUP BY r),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         len(t) - len(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
         len(t) - len(replace(t, '!', '')) AS n_exclaim,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutter
  FROM d LEFT JOIN cov ON d.r = cov.r),
f AS (
  SELECT *, CAST(
      CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_upper > 3 * word_chars THEN 16 ELSE 0 END
    + CASE WHEN 5 * n_exclaim > n_words THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_stutter > 30 * n_words THEN 64 ELSE 0 END
    + CASE WHEN word_chars > 30 * n_words THEN 128 ELSE 0 END AS BIGINT) AS failures
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failures & 3) <> 0 AS base_failed, failures = 0 AS kept, failures
FROM f
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
s AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0),
g AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS a
  FROM s, range(1, 4) AS t(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
n AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (
  SELECT * FROM g WHERE a >= 10),
c AS (
  SELECT lang, phrase, k, a, j, string_split(phrase, ' ') AS w FROM f, range(1, 3) AS t(j) WHERE j < k),
x AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.j, l.a AS l, r.a AS r,
         1000000::HUGEINT * c.a * c.a // (l.a::HUGEINT * r.a) AS score
  FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:c.j], ' ')
         JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.j + 1:], ' ')),
b AS (
  SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
d AS (
  SELECT DISTINCT b.lang, b.phrase
  FROM b JOIN c t ON t.k = 3 AND t.lang = b.lang
    AND b.phrase = array_to_string(t.w[t.j:t.j + 1], ' ') AND 100 * t.a >= 50 * b.a
  WHERE b.k = 2),
q AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM b ANTI JOIN d USING (lang, phrase))
SELECT q.lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n.n, CAST(score AS BIGINT) AS score
FROM q JOIN n ON n.lang = q.lang WHERE rank <= 2000
"""

#: CRC-32 of a word's UTF-8 bytes: the table of its polynomial, then one look-up a byte.
CRC = """list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(0, len(hex(w)) // 2), lambda i: CAST('0x' || substr(hex(w), 2 * i + 1, 2) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))"""

OP12 = rf"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
  FROM range(256) AS x(n)),
d AS (
  SELECT row_number() OVER () AS i, doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
f AS (
  SELECT 0 AS side, i, unnest(words) AS w FROM d
  UNION ALL
  SELECT 1, NULL, unnest(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
v AS (
  SELECT w, xor({CRC}, 4294967295::BIGINT) % 10000 AS bucket FROM (SELECT DISTINCT w FROM f), crc),
b AS (
  SELECT side, i, bucket, count(*) AS n FROM f JOIN v USING (w) GROUP BY ALL),
o AS (
  SELECT bucket, CAST(sum(n) FILTER (side = 0) AS DOUBLE) AS s, CAST(coalesce(sum(n) FILTER (side = 1), 0) AS DOUBLE) AS t
  FROM b GROUP BY bucket),
g AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(coalesce(s, 0)) OVER () + 10000)
                                      / ((coalesce(s, 0) + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
  FROM o),
w AS (
  SELECT i, CAST(sum(n * gain) AS BIGINT) AS weight FROM b JOIN g USING (bucket) WHERE side = 0 GROUP BY i),
h AS (
  SELECT d.i, doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN w ON d.i = w.i),
c AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM h),
r AS (
  SELECT i, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS rank, count(*) OVER () AS all_rows
  FROM c WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * all_rows // 100 THEN rank END AS rank
FROM c LEFT JOIN r ON c.i = r.i
"""

OP1 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM d WHERE len(w) > 0),
n AS (
  SELECT r, count(*) AS n FROM s GROUP BY r),
i AS (
  SELECT a.r AS a, b.r AS b, count(*) AS shared FROM s a JOIN s b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
l AS (
  SELECT a, b FROM i JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c AS (
  SELECT r, doc_id AS low FROM d
  UNION
  SELECT e.b, c.low FROM c JOIN e ON e.a = c.r JOIN d ON d.r = e.b WHERE c.low < d.doc_id OR d.doc_id IS NULL),
m AS (
  SELECT r, min(low) AS low FROM c GROUP BY r)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, low AS component_id, doc_id IS NOT DISTINCT FROM low AS kept
FROM d JOIN m ON m.r = d.r LEFT JOIN n ON n.r = d.r
"""

OP2 = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS h FROM documents),
p AS (
  SELECT r, unnest(range(0, len(h) // 2)) AS j, h FROM d),
w AS (
  SELECT r, j, CASE WHEN 2 * (j + 400) <= len(h) THEN md5(substr(h, 2 * j + 1, 800)) END AS g, substr(h, 2 * j + 1, 2) AS b FROM p),
m AS (
  SELECT r, j, b, CASE WHEN g IS NOT NULL AND count(*) OVER (PARTITION BY g) > 1 THEN j END AS hit FROM w),
x AS (
  SELECT r, j, b, coalesce(last_value(hit IGNORE NULLS) OVER (PARTITION BY r ORDER BY j) > j - 400, false) AS gone FROM m),
y AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY j), false) AS first FROM x),
z AS (
  SELECT r, count(*) AS n, count(*) FILTER (gone) AS n_removed, count(*) FILTER (first) AS n_spans,
         coalesce(string_agg(b, '' ORDER BY j) FILTER (NOT gone), '') AS rest
  FROM y GROUP BY r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(rest, ''))) AS kept_sha256
FROM d LEFT JOIN z ON d.r = z.r
"""

OP4 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
p AS (
  SELECT r, unnest(range(1, len(w) + 1)) AS j, w FROM d),
w AS (
  SELECT r, j, w[j] AS word, CASE WHEN j + 34 <= len(w) THEN md5(array_to_string(w[j:j + 34], ' ')) END AS g FROM p),
m AS (
  SELECT r, j, word, CASE WHEN g IS NOT NULL AND count(*) OVER (PARTITION BY g) > 1 THEN j END AS hit FROM w),
x AS (
  SELECT r, j, word, coalesce(last_value(hit IGNORE NULLS) OVER (PARTITION BY r ORDER BY j) > j - 35, false) AS gone FROM m),
y AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY j), false) AS first FROM x),
z AS (
  SELECT r, count(*) FILTER (gone) AS n_removed, count(*) FILTER (first) AS n_spans, string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS rest
  FROM y GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN z ON d.r = z.r
"""

ORACLES = {
    "op1_minhash_dedup": OP1,
    "op2_suffix_array_dedup": OP2,
    "op4_substring_dedup": OP4,
    "op12_importance_resampling": OP12,
    "op11_phrase_mining": OP11,
    "op7_mixing": OP7,
    "op10_quality_rules": OP10,
}
