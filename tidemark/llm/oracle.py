"""SQL for the queries that SQL can express, on the same tables.

The others are tested against restatements in plain Python: scores of trained models (1, 10),
pseudorandom draws (2), budgeted windows (5), patterns with context (7), decoded keys (9).
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"
_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_CONTAMINATION = rf"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS w FROM benchmark),
piece AS (
  SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS x FROM piece),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS w FROM documents),
size AS (SELECT DISTINCT len(x) AS n FROM win),
place AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size WHERE len(w) >= n),
hit AS (
  SELECT p.doc_id, p.i, p.n, v.item_id
  FROM (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS x FROM place) p JOIN win v ON p.x = v.x),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hit) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(f.items, '')) AS items_sha256,
  coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id
"""


def _base32(hexadecimal: str) -> str:
    """SQL of the base32 text of 40 hexadecimal digits: five digits make four letters."""
    letters = []
    for k in range(8):
        value = f"CAST(concat('0x', substr({hexadecimal}, {5 * k + 1}, 5)) AS INTEGER)"
        letters += [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({value} >> {s}) & 31) + 1, 1)" for s in (15, 10, 5, 0)]
    return f"concat({', '.join(letters)})"


_ARCHIVE = f"""
WITH page AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {_base32("digest")} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM page
"""

_NEAR_DUPLICATES = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{_WORD}') AS w FROM documents),
shingle AS (
  SELECT doc_id, s, count(*) AS c FROM (
    SELECT doc_id, list_slice(w, i, i + 4) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0))
  GROUP BY doc_id, s),
size AS (SELECT doc_id, sum(c) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.c, b.c)) AS n
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT c.a, c.b FROM common c JOIN size x ON x.doc_id = c.a JOIN size y ON y.doc_id = c.b
  WHERE CAST(c.n AS DOUBLE) / CAST(x.n + y.n - c.n AS DOUBLE) >= 0.8
  UNION
  SELECT min(doc_id) OVER (), doc_id FROM doc WHERE len(w) = 0),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM doc
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edge e ON r.other = e.a)
SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id
"""

def quality_sql(host: str = "source", line_texts: int = 20) -> str:
    return rf"""
WITH doc AS (
  SELECT doc_id, CASE WHEN {host} IS NULL THEN '' ELSE concat('=', {host}) END AS host, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
raw AS (
  SELECT doc_id, host, t, len(w) AS n_words, unnest(ls) AS y
  FROM (SELECT *, string_split(regexp_replace(lower(t), '\x20{{2,}}|[\x09\x0B-\x0D]+', ' ', 'g'), chr(10)) AS ls FROM doc)),
line AS (
  SELECT doc_id, host, t, n_words, x, regexp_extract_all(x, '{_WORD}') AS ws, len(regexp_extract_all(x, '{_WORD}')) AS n
  FROM (SELECT *, trim(CASE WHEN regexp_matches(y, '\p{{L}}') THEN regexp_replace(y, '\b[0-9]+\b', '0', 'g') ELSE y END, ' ') AS x FROM raw)
  WHERE x <> ''),
often AS (SELECT host, x FROM line GROUP BY host, x HAVING count(DISTINCT t) > {line_texts}),
found AS (SELECT l.* FROM line l JOIN often o ON o.host = l.host AND o.x = l.x),
rated AS (SELECT doc_id, sum(n) <= 0.5 * n_words AS by_lines FROM found GROUP BY doc_id, n_words),
mostly AS (
  SELECT l.*, o.x IS NOT NULL AS frequent FROM line l JOIN rated r ON r.doc_id = l.doc_id AND NOT r.by_lines
  LEFT JOIN often o ON o.host = l.host AND o.x = l.x),
place AS (SELECT *, unnest(range(1, n + 1)) AS i FROM mostly),
pair AS (SELECT doc_id, host, t, n_words, frequent, ws[i] AS a, coalesce(ws[i + 1], chr(10)) AS b FROM place),
common AS (SELECT host, a, b FROM pair GROUP BY host, a, b HAVING count(DISTINCT t) > {line_texts}),
own AS (
  SELECT doc_id FROM rated WHERE by_lines
  UNION ALL
  SELECT p.doc_id FROM pair p LEFT JOIN common c ON c.host = p.host AND c.a = p.a AND c.b = p.b
  WHERE NOT p.frequent AND c.host IS NULL GROUP BY p.doc_id, p.n_words HAVING count(*) >= CAST(1 AS DOUBLE) / 9 * p.n_words),
gone AS (
  SELECT f.host, f.x FROM found f JOIN own o ON o.doc_id = f.doc_id
  GROUP BY f.host, f.x HAVING count(DISTINCT f.t) > {line_texts}),
removed AS (
  SELECT f.doc_id, sum(f.n) AS removed_words FROM found f JOIN gone g ON g.host = f.host AND g.x = f.x GROUP BY f.doc_id),
triple AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM doc),
twice AS (
  SELECT doc_id, unnest(list(i)) AS i
  FROM (SELECT doc_id, i, list_slice(w, i, i + 2) AS x FROM triple) GROUP BY doc_id, x HAVING count(*) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS pos FROM twice) GROUP BY doc_id),
stat AS (
  SELECT d.doc_id, len(d.w) AS n_words, length(array_to_string(d.w, '')) AS word_chars,
    length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(d.t, chr(10)), lambda y: regexp_matches(y, '{_WORD}')) AS lines,
    coalesce(r.n, 0) AS n_repeat_words, coalesce(v.removed_words, 0) AS removed_words
  FROM doc d LEFT JOIN repeated r ON r.doc_id = d.doc_id LEFT JOIN removed v ON v.doc_id = d.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  CAST(removed_words AS BIGINT) AS removed_words,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - removed_words >= 0.3 * n_words AS kept
FROM stat
"""

_JACCARD = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 3) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT c.a, c.b FROM common c JOIN size x ON x.doc_id = c.a JOIN size y ON y.doc_id = c.b
  WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM doc
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edge e ON r.other = e.a)
SELECT r.doc_id, CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM reach r LEFT JOIN size s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""

_FILTER_AUDIT = rf"""
WITH label AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS repeats
  FROM documents),
judged AS (
  SELECT d.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
    concat(
      CASE WHEN len(w) < 50 THEN 'A' ELSE '' END,
      CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END,
      CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
      CASE WHEN repeats THEN 'E' ELSE '' END) AS fails
  FROM doc d LEFT JOIN label l ON l.doc_id = d.doc_id),
cell AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, fails),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
sequence AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE length(translate('ABCDE', concat(a.x, b.x, c.x, d.x, e.x), '')) = 0),
step AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before FROM sequence, range(1, 6) AS s(step)),
-- the letters of the order so far that a row fails
placed AS (
  SELECT c.*, s.*, contains(fails, x) AS hit, length(fails) - length(translate(fails, before, '')) AS earlier
  FROM cell c, step s),
share AS (
  SELECT part, x, sum(n) AS shapley FROM placed WHERE hit AND earlier = 0 GROUP BY part, x)
SELECT p.part, p.filter_order, CAST(p.step AS INTEGER) AS step,
  CAST(sum(CASE WHEN NOT hit AND earlier = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN hit AND earlier = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN hit AND earlier > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN fails = p.x THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN hit AND earlier = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN hit AND earlier = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
  CAST(coalesce(any_value(h.shapley), 0) AS BIGINT) AS shapley
FROM placed p LEFT JOIN share h ON h.part = p.part AND h.x = p.x
GROUP BY p.part, p.filter_order, p.step
"""

_PHRASES = rf"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS x FROM documents),
words AS (SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS w FROM piece),
size AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
place AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 5) AS s(k) WHERE len(w) >= k),
f AS (
  SELECT lang, p, len(p) AS k, count(*) AS a
  FROM (SELECT lang, list_slice(w, i, i + k - 1) AS p FROM place) GROUP BY lang, p HAVING count(*) >= 30),
cut AS (
  SELECT c.lang, c.p, c.a, s.k, x.a AS l, y.a AS r, (CAST(2000000 AS HUGEINT) * c.a) // (x.a + y.a) AS score
  FROM f c JOIN range(1, 4) AS s(k) ON s.k < c.k
  JOIN f x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, s.k)
  JOIN f y ON y.lang = c.lang AND y.p = list_slice(c.p, s.k + 1, c.k)),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
start AS (SELECT lang, p, k, a, unnest(range(1, k + 1)) AS i FROM f WHERE k > 2),
inner_phrase AS (
  SELECT lang, list_slice(p, i, i + n - 1) AS p, max(a) AS longer
  FROM start, range(2, 4) AS s(n) WHERE n < k AND i + n - 1 <= k GROUP BY ALL),
kept AS (
  SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM best b LEFT JOIN inner_phrase i ON i.lang = b.lang AND i.p = b.p
  WHERE i.longer IS NULL OR CAST(100 AS HUGEINT) * i.longer < CAST(80 AS HUGEINT) * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, CAST(s.n AS BIGINT) AS n, CAST(r.score AS BIGINT) AS score
FROM ranked r JOIN size s ON s.lang = r.lang WHERE r.rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": _CONTAMINATION,
    "op4_warc": _ARCHIVE,
    "op6_near_duplicates": _NEAR_DUPLICATES,
    "op8_quality_rules": quality_sql(),
    "quality_by_language": quality_sql("lang", 5),
    "op11_jaccard_join": _JACCARD,
    "op12_filter_audit": _FILTER_AUDIT,
    "op13_phrases": _PHRASES,
}
