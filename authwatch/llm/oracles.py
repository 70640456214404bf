"""SQL twins of the queries that SQL can express over whole tables, for DuckDB."""

from __future__ import annotations

import string

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

EXACT_DEDUP = r"""
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
           AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM hashed WINDOW same AS (PARTITION BY text_sha256)"""

SUBSTRING_DEDUP = f"""
WITH texts AS (
  SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS words FROM documents),
windows AS (
  SELECT doc_id, place, array_to_string(list_slice(words, place, place + 12), ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS place FROM texts)),
firsts AS (SELECT gram, min(doc_id) AS first_doc FROM windows GROUP BY gram HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + 13)) AS place
  FROM windows JOIN firsts USING (gram) WHERE first_doc < doc_id),
placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(gone.place) AS n_removed,
         string_agg(word, ' ' ORDER BY placed.place) FILTER (WHERE gone.place IS NULL) AS rest
  FROM placed LEFT JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)"""

LOWER = (f"translate(coalesce(text, ''), '{string.ascii_uppercase}', "
         f"'{string.ascii_lowercase}')")

JACCARD = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, {WORDS.format(text=LOWER)} AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, place, place + 4), ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(
          len(words) - 3, CASE WHEN len(words) > 0 THEN 2 ELSE 1 END))) AS place FROM texts)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS common
  FROM shingles l JOIN shingles r ON l.gram = r.gram AND l.doc_id < r.doc_id GROUP BY ALL),
links AS (
  SELECT a, b, x.n = common AND y.n = common AS equal
  FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)),
edges AS (SELECT a, b, equal FROM links UNION ALL SELECT b, a, equal FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM sizes
  UNION SELECT reached.doc_id, edges.b FROM reached JOIN edges ON edges.a = reached.other),
least AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id),
near AS (
  SELECT a AS doc_id, count(*) AS n_links, min(b) FILTER (equal) AS copy FROM edges GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(other, doc_id) AS component_id,
       least(doc_id, coalesce(copy, doc_id)) AS class_id, coalesce(n_links, 0) AS n_links
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
LEFT JOIN near USING (doc_id)"""

# Five bits of the hexadecimal digest at a time, as letters.
BASE32 = f"""array_to_string(list_transform(range(32), lambda i: substr(
  '{string.ascii_uppercase}234567', CAST(1 + (((16 * (strpos('0123456789abcdef',
  substr(digest, CAST(5 * i // 4 + 1 AS BIGINT), 1)) - 1) + strpos('0123456789abcdef',
  substr(digest, CAST(5 * i // 4 + 2 AS BIGINT), 1)) - 1) >> (3 - (5 * i) % 4)) & 31)
  AS BIGINT), 1)), '')"""

WARC = f"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha1(coalesce(html, '')) AS digest FROM pages),
winners AS (SELECT digest, max(page_id) AS winner FROM hashed GROUP BY digest)
SELECT page_id, payload_bytes, {BASE32} AS payload_digest,
       CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> winner THEN winner END AS refers_to
FROM hashed JOIN winners USING (digest)"""

QUALITY = f"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         {WORDS.format(text="coalesce(text, '')")} AS words FROM documents),
lines AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM texts),
worded AS (
  SELECT doc_id, source, text, line, words FROM (
    SELECT *, {WORDS.format(text="line")} AS words FROM lines) WHERE len(words) > 0),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY doc_id),
windows AS (
  SELECT doc_id, place, array_to_string(list_slice(words, place, place + 7), ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS place FROM texts)),
twice AS (SELECT doc_id, gram FROM windows GROUP BY ALL HAVING count(*) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(range(place, place + 8)) AS place
    FROM windows JOIN twice USING (doc_id, gram)) GROUP BY doc_id),
normal_lines AS (
  SELECT doc_id, source, text, lower(array_to_string(words, ' ')) AS line, len(words) AS n
  FROM worded),
same_texts AS (
  SELECT source, text, count(DISTINCT doc_id) AS documents, min(doc_id) AS least,
         len(any_value(words)) < 20 OR 100 * coalesce(any_value(repeats.n), 0)
           > 30 * len(any_value(words)) AS text_failed
  FROM texts LEFT JOIN repeats USING (doc_id) GROUP BY source, text),
held AS (SELECT DISTINCT source, text, line FROM normal_lines),
frequent AS (
  SELECT held.source, line, arg_min(held.text, (-documents, least)) FILTER (WHERE NOT text_failed) AS spared
  FROM held JOIN same_texts ON held.source IS NOT DISTINCT FROM same_texts.source
    AND held.text = same_texts.text
  GROUP BY ALL HAVING sum(documents) > 20),
hits AS (
  SELECT doc_id, sum(n) AS removed FROM normal_lines l JOIN frequent f
    ON l.source IS NOT DISTINCT FROM f.source AND l.line = f.line
  WHERE text IS DISTINCT FROM spared GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
         CAST(coalesce(removed, 0) AS BIGINT) AS boilerplate_words
  FROM texts LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id)
       LEFT JOIN hits USING (doc_id)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND n_words - boilerplate_words >= 20
          AND n_words - boilerplate_words >= n_words * 0.3 AS kept FROM judged"""

HARD_NEGATIVES = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10
                      ELSE CAST(label AS BIGINT) END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
         AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""

DIVERGENCE = rf"""
WITH documents_of AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({LOWER},
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
uses AS (SELECT doc, lang, source, unnest(terms) AS term FROM documents_of),
kept AS (
  SELECT lang, term, count(*) AS lang_count FROM uses
  GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
sizes AS (SELECT lang, count(*) AS v, sum(lang_count) AS lang_n FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS c FROM uses GROUP BY ALL),
pairs_of AS (
  SELECT DISTINCT lang, source FROM documents_of),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, lang_count, v, lang_n
  FROM pairs_of g JOIN kept k USING (lang) JOIN sizes USING (lang)
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (
  SELECT lang, source, term, c,
         CAST(1 + (1000000000 * CAST(c + 2 AS HUGEINT))
           // (sum(c) OVER (PARTITION BY lang, source) + 2 * v) AS BIGINT) AS p,
         CAST(1 + (1000000000 * CAST(lang_count + 2 AS HUGEINT)) // (lang_n + 2 * v) AS BIGINT) AS q
  FROM cells),
summed AS (
  SELECT a.lang, a.source, b.source AS item,
         CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
paired AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM pairs_of a JOIN pairs_of b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM paired
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares
  WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)
         AS INTEGER) AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 10"""

ORACLES = {
    "op5_quality_rules": QUALITY,
    "op3_exact_dedup": EXACT_DEDUP,
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op9_jaccard_trie": JACCARD,
    "op10_warc_zip": WARC,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_source_divergence": DIVERGENCE,
}
