"""DuckDB SQL with the same rows as the queries, where SQL can express them."""

_WS = r"'[\x20\x09-\x0D]+'"
_WS_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_PLAIN = "replace(replace(lower(t), '.', ''), ',', '')"
_TERM = """(CASE WHEN p > 0 THEN 0.5 * p * log2(2 * p / (p + q)) ELSE 0 END
            + CASE WHEN q > 0 THEN 0.5 * q * log2(2 * q / (p + q)) ELSE 0 END)"""

DIVERGENCE_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, [x for x in regexp_split_to_array(t, {_WS}) if x <> ''] AS words,
             [x for x in string_split(t, chr(10)) if length(translate(x, {_WS_CHARS}, '')) > 0] AS lines FROM d),
g AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
      FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT rid, count(DISTINCT i + o) AS n_repeat_words
        FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g), (SELECT unnest([0, 1, 2]) AS o)
        WHERE n > 1 GROUP BY rid),
base AS (
  SELECT w.rid, doc_id, lang, t, words, len(words) AS n_words, length(t) AS n_chars,
         length(translate(t, {_WS_CHARS}, '')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN rep ON w.rid = rep.rid),
classes AS (
  SELECT *, [n_letter - n_upper, n_upper, n_digit, n_chars - word_chars, n_symbols,
             word_chars - n_letter - n_digit - n_symbols] AS cls
  FROM (SELECT *, n_chars - length(regexp_replace(t, '\p{{L}}+', '', 'g')) AS n_letter,
               n_chars - length(regexp_replace(t, '\p{{Lu}}+', '', 'g')) AS n_upper,
               n_chars - length(translate(t, '0123456789', '')) AS n_digit FROM base)),
langs AS (
  SELECT lang, sum(n_chars) AS lang_chars, sum(n_words) AS lang_words FROM classes WHERE lang IS NOT NULL
  GROUP BY lang HAVING count(*) * 200 >= (SELECT count(*) FROM documents)),
ref_classes AS (
  SELECT c.lang, k, sum(cls[k]) / any_value(lang_chars) AS q
  FROM classes c JOIN langs USING (lang), (SELECT unnest(range(1, 7)) AS k) GROUP BY c.lang, k),
tokens AS (
  SELECT rid, word, count(*) AS n
  FROM (SELECT rid, unnest(regexp_split_to_array({_PLAIN}, {_WS})) AS word FROM d) GROUP BY rid, word),
ref_words AS (
  SELECT lang, word, n / lang_words AS q
  FROM (SELECT lang, word, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS r
        FROM (SELECT lang, unnest(regexp_split_to_array(lower(t), '[^\p{{L}}]+')) AS word FROM d)
        WHERE lang IS NOT NULL AND word <> '' GROUP BY lang, word) JOIN langs USING (lang) WHERE r <= 20),
dist_chars AS (
  SELECT rid, sqrt(greatest(sum({_TERM}), 0)) AS char_distance
  FROM (SELECT rid, cls[k] / n_chars AS p, q FROM classes JOIN ref_classes USING (lang) WHERE n_chars > 0) GROUP BY rid),
word_pairs AS (
  SELECT b.rid, coalesce(n, 0) / n_words AS p, q
  FROM base b JOIN ref_words r USING (lang) LEFT JOIN tokens k ON k.rid = b.rid AND k.word = r.word WHERE n_words > 0),
dist_words AS (
  SELECT rid, sqrt(greatest(sum({_TERM}), 0)) AS word_distance
  FROM (SELECT * FROM word_pairs
        UNION ALL SELECT rid, greatest(1 - sum(p), 0), greatest(1 - sum(q), 0) FROM word_pairs GROUP BY rid)
  GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
       CASE WHEN failed THEN false WHEN n_words < 50 THEN true
            ELSE NOT (coalesce(char_distance > 0.15 + 0.8 / sqrt(n_words), false)
                      OR coalesce(word_distance > 0.13 + 1.9 / sqrt(n_words), false)) END AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS failed FROM base)
LEFT JOIN dist_chars USING (rid) LEFT JOIN dist_words USING (rid)"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS words FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT item_id, n, array_to_string(list_slice(words, i, i + n - 1), ' ') AS win
  FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i
        FROM (SELECT *, least(13, len(words)) AS n FROM b) WHERE n > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
runs AS (
  SELECT rid, n, i, array_to_string(list_slice(words, i, i + n - 1), ' ') AS win
  FROM (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, sizes)),
hits AS (SELECT DISTINCT rid, i, r.n, item_id FROM runs r JOIN windows w ON r.win = w.win),
covered AS (
  SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS digest FROM pages),
s AS (SELECT *, strlen(payload) AS size FROM p),
f AS (SELECT digest, min(page_id) AS first FROM s WHERE size >= 100 GROUP BY digest)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
       CASE WHEN size >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 100 AND page_id <> first THEN first END AS refers_to
FROM s LEFT JOIN f USING (digest)"""

_TRIMMED = rf"lower(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'))"

LINE_SPREAD = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (
  SELECT rid, doc_id, source, i, line,
         CASE WHEN len([w FOR w IN regexp_split_to_array({_TRIMMED}, {_WS}) IF w <> '']) >= 4 THEN {_TRIMMED} END AS key
  FROM (SELECT rid, doc_id, source, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM d)),
spread AS (
  SELECT key, count(DISTINCT coalesce(source, '')) AS sites,
         min({{'none': doc_id IS NULL, 'id': doc_id, 'i': i}}) AS first
  FROM l WHERE key IS NOT NULL GROUP BY key HAVING count(DISTINCT coalesce(source, '')) >= 8),
m AS (
  SELECT l.*, spread.key IS NOT NULL AND {{'none': doc_id IS NULL, 'id': doc_id, 'i': i}} <> first AS gone
  FROM l LEFT JOIN spread ON l.key = spread.key),
c AS (
  SELECT rid, count(key) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS clean
  FROM m GROUP BY rid)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN text IS NOT NULL THEN sha256(coalesce(clean, '')) END AS clean_sha256
FROM d LEFT JOIN c USING (rid)"""


PHRASES = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
                  regexp_split_to_array({_FOLDED}, '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT rid, lang, unnest(pieces) AS piece FROM d),
w AS (SELECT row_number() OVER () AS pid, lang, [x for x in regexp_split_to_array(piece, '[\x20\x09]+') if x <> ''] AS words FROM p),
total AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, size, words, unnest(range(1, len(words) - size + 2)) AS i
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(words) >= size),
f AS (
  SELECT lang, size, array_to_string(list_slice(words, i, i + size - 1), ' ') AS phrase, count(*) AS a
  FROM grams GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE size > 1),
cuts AS (
  SELECT lang, phrase, size, a, k, array_to_string(list_slice(words, 1, k), ' ') AS head,
         array_to_string(list_slice(words, k + 1, size), ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r,
         CAST(CAST(c.a AS HUGEINT) * 2000000 // (x.a + y.a) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
worst AS (
  SELECT lang, phrase, a, l, r, score
  FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored) WHERE place = 1),
inside AS (
  SELECT lang, array_to_string(list_slice(words, i, i + part - 1), ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, words, a, part, unnest(range(1, size - part + 2)) AS i
        FROM (SELECT *, unnest(range(2, size)) AS part FROM c)) GROUP BY ALL),
ranked AS (
  SELECT worst.*, row_number() OVER (PARTITION BY worst.lang ORDER BY score DESC, a DESC, encode(worst.phrase)) AS rank
  FROM worst LEFT JOIN inside ON inside.lang = worst.lang AND inside.phrase = worst.phrase
  WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""
