"""SQL twins of the corpus queries that SQL can express, over whole tables and whole texts."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"[^\x20\x09-\x0D]+"
ALPHANUMERIC_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(table: str, key: str, pattern: str, lower: bool) -> str:
    """One row per text: its key, a row number and its words; a null text has none."""
    text = "coalesce(text, '')"
    return (f"SELECT {key}, row_number() OVER () AS r, "
            f"regexp_extract_all({LOWER.format(text) if lower else text}, '{pattern}') AS w FROM {table}")


#: A word is covered if some hit window that starts at or before it reaches it, so the furthest end
#: so far tells.
DECONTAMINATION = f"""
WITH d AS MATERIALIZED ({words_of('documents', 'doc_id', ALPHANUMERIC_WORDS, True)}),
b AS MATERIALIZED ({words_of('benchmark', 'item_id', ALPHANUMERIC_WORDS, True)}),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS window_text FROM (
    SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s
    FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
starts AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d CROSS JOIN sizes WHERE len(w) >= size),
found AS MATERIALIZED (
  SELECT r, s, s + size - 1 AS last, item_id
  FROM (SELECT r, s, size, array_to_string(w[s:s + size - 1], ' ') AS window_text FROM starts)
  JOIN windows USING (size, window_text)),
reach AS (SELECT r, s, max(last) AS last FROM found GROUP BY r, s),
fresh AS (
  SELECT r, s, last, max(last) OVER (PARTITION BY r ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto
  FROM reach),
hits AS (SELECT r, sum(greatest(0, last - greatest(s, coalesce(upto, 0) + 1) + 1)) AS n_hit FROM fresh GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)"""

SUBSTRING_DEDUP = f"""
WITH d AS MATERIALIZED ({words_of('documents', 'doc_id', WORDS, False)}),
windows AS MATERIALIZED (
  SELECT r, doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS h
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS first_doc FROM windows GROUP BY h),
hits AS (SELECT r, s FROM windows JOIN firsts USING (h) WHERE first_doc < doc_id),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS s FROM d),
judged AS (
  SELECT r, s, word, count(hits.s) OVER (PARTITION BY r ORDER BY s ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS n
  FROM words LEFT JOIN hits USING (r, s)),
kept AS (
  SELECT r, count(*) FILTER (n > 0) AS n_removed, string_agg(word, ' ' ORDER BY s) FILTER (n = 0) AS body
  FROM judged GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


def url_filter(listed_pattern: str) -> str:
    """Rules by length, then the list. A parent of a listed host may be none, but a host with a listed
    parent has the parent's listed part itself, so the pattern on the host tells."""
    return rf"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS s FROM pages),
p AS (SELECT page_id, {LOWER.format("regexp_extract(s, '^[^/?#]*')")} AS host, regexp_extract(s, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
r AS (SELECT *, CASE
  WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
  WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
  WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
  WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
  WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(host, '{listed_pattern}') THEN 'block' ELSE 'allow' END AS verdict FROM r"""


RANKED_SEARCH = f"""
WITH d AS MATERIALIZED ({words_of('documents', 'doc_id', ALPHANUMERIC_WORDS, True)}),
b AS MATERIALIZED ({words_of('benchmark', 'item_id', ALPHANUMERIC_WORDS, True)}),
totals AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_words FROM d WHERE len(w) > 0),
asked AS (SELECT r AS item, word, count(*) AS q FROM (SELECT r, unnest(w) AS word FROM b) GROUP BY r, word),
tf AS MATERIALIZED (
  SELECT r, word, count(*) AS tf FROM (SELECT r, unnest(w) AS word FROM d)
  WHERE word IN (SELECT word FROM asked) GROUP BY r, word),
weights AS (
  SELECT word, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT word, count(*) AS df FROM tf GROUP BY word) CROSS JOIN totals),
norms AS (SELECT r, doc_id, 25 + (75 * CAST(len(w) AS BIGINT) * n_docs) // n_words AS m FROM d CROSS JOIN totals WHERE len(w) > 0),
gains AS (SELECT r, doc_id, word, weight * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS gain FROM tf JOIN norms USING (r) JOIN weights USING (word)),
scores AS (SELECT item, r, doc_id, CAST(sum(q * gain) AS BIGINT) AS score FROM gains JOIN asked USING (word) GROUP BY item, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT b.item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked JOIN b ON b.r = item WHERE place <= 10"""

PHRASE_COLLOCATIONS = f"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, {LOWER.format("coalesce(text, '')")} AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
words AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
spans AS (
  SELECT lang, w[s:s + size - 1] AS p FROM (
    SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM words CROSS JOIN (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size)),
counts AS MATERIALIZED (SELECT lang, p, count(*) AS a FROM spans GROUP BY lang, p HAVING count(*) >= 100),
longer AS (
  SELECT lang, p, max(a) AS longer FROM (
    SELECT lang, p[1:len(p) - 1] AS p, a FROM counts WHERE len(p) > 2
    UNION ALL SELECT lang, p[2:] AS p, a FROM counts WHERE len(p) > 2) GROUP BY lang, p),
cuts AS (SELECT lang, p, a, k, p[1:k] AS head, p[k + 1:] AS rest FROM (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM counts WHERE len(p) > 1)),
scored AS (
  SELECT c.lang, c.p, c.a, k, l.a AS l, r.a AS r, n,
    CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.p = c.head JOIN counts r ON r.lang = c.lang AND r.p = c.rest JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
kept AS (SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.p = b.p WHERE longer IS NULL OR longer < a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS place FROM kept)
SELECT lang, CAST(place AS INTEGER) AS rank, phrase, a, l, r, n, score FROM ranked WHERE place <= 2000"""
