"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from citeflow.llm.license_scan import NOTICES, PHRASES
from citeflow.llm.quality_rules import STOP_WORDS

_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

OP4 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_SPACED} AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)
),
dup AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
rep AS (
  SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM dup)
  GROUP BY doc_id
),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
m AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: x IN ({_STOP}))) AS n_stop_words
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)
),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 1.5 * n_words AND word_chars <= 25 * n_words
  AND n_symbols <= 0.3 * n_words AND (n_words < 50 OR n_stop_words >= 0.02 * n_words)
  AND n_dup_lines <= 0.5 * n_lines AS kept
FROM b
"""

# A round of sharing clamps at least one source; 40 rounds cover the 20 sources of the tables.
OP7 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len({_SPACED}) AS size,
    ('0x' || substr(md5('7|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))
      ::BIGINT AS h
  FROM documents
),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source
),
lvl AS (
  SELECT 0 AS k, (SELECT sum(source_size) / sum(weight) FROM s)::DOUBLE AS level
  UNION ALL
  SELECT k + 1, (
    SELECT coalesce((sum(source_size) - sum(CASE WHEN weight * level > 3 * source_size
        THEN 3 * source_size ELSE 0 END))
      / nullif(sum(CASE WHEN weight * level > 3 * source_size THEN 0 ELSE weight END), 0), level)
    FROM s)::DOUBLE
  FROM lvl WHERE k < 40
),
t AS (
  SELECT source, source_size, least(weight * level, (3 * source_size)::DOUBLE) AS target
  FROM s, (SELECT level FROM lvl ORDER BY k DESC LIMIT 1)
),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t
),
u AS (SELECT source, h, sum(size) AS n FROM d GROUP BY ALL),
c AS (
  SELECT u.source, h, n, target - whole * source_size AS need,
    sum(n) OVER (PARTITION BY u.source ORDER BY h) AS upto
  FROM u JOIN p ON u.source IS NOT DISTINCT FROM p.source
),
cut AS (
  SELECT source, CASE WHEN upto - need <= need - (upto - n) THEN h ELSE h - 1 END AS cut
  FROM c WHERE need > 0 AND n > 0 AND upto >= need AND upto - n < need
)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN h <= coalesce(cut, -1) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN cut ON d.source IS NOT DISTINCT FROM cut.source
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_TEMPLATES = (*PHRASES, *NOTICES)
_LISTED = ", ".join(f"({k}, '{t.label}', {t.phrase}, '{t.text}')" for k, t in enumerate(_TEMPLATES))
OP2 = f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
t AS (
  SELECT template, label, phrase, string_split(body, ' ') AS tw
  FROM (VALUES {_LISTED}) AS x(template, label, phrase, body)
),
tp AS (
  SELECT template, i, tw[i] || ' ' || tw[i + 1] AS pair
  FROM (SELECT template, tw, unnest(range(1, len(tw))) AS i FROM t)
),
dp AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] AS pair
  FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)
),
v AS (
  SELECT doc_id, template, dp.i - tp.i AS diagonal, list(DISTINCT tp.i) AS seen
  FROM dp JOIN tp USING (pair) GROUP BY ALL
),
u AS (
  SELECT v.*, phrase, label, len(tw) - 1 AS size FROM v JOIN t USING (template)
  WHERE CASE WHEN phrase THEN len(seen) = len(tw) - 1 ELSE len(seen) >= least(3, len(tw) - 1) END
),
g AS (
  SELECT *, CASE WHEN phrase OR coalesce(diagonal - lag(diagonal) OVER o, 99) > 3 THEN 1 ELSE 0 END AS new
  FROM u WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)
),
h AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS part FROM g),
m AS (
  SELECT doc_id, template, part, any_value(phrase) AS phrase, any_value(label) AS label, min(diagonal) AS start,
    len(list_distinct(flatten(list(seen)))) / any_value(size) AS share
  FROM h GROUP BY doc_id, template, part
),
f AS (
  SELECT doc_id, count(*) FILTER (phrase) AS n_base, min(start) FILTER (phrase) AS first_word,
    max(start) FILTER (phrase) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (share >= 0.6) AS labels, max(share) AS score
  FROM m GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN f USING (doc_id)
"""

OP3 = rf"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, {_ALNUM} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
place AS (
  SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM d, (SELECT DISTINCT m FROM win))
),
occ AS (SELECT doc_id, i, place.m, item FROM place JOIN win ON place.m = win.m AND place.s = win.s),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM occ) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_B32 = " || ".join(
    f"'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(v >> {shift} & 31) + 1]" for shift in (15, 10, 5, 0)
)
OP5 = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest
  FROM pages
)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(
    list_transform(range(8), lambda g: ('0x' || substr(hex, g * 5 + 1, 5))::BIGINT), lambda v: {_B32}
  ), '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM largest AND largest IS NOT NULL THEN 'revisit' ELSE 'response'
  END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to
FROM p
"""

ORACLES = {
    "op2_license_scan": OP2,
    "op3_decontaminate": OP3,
    "op4_quality_rules": OP4,
    "op5_warc_archives": OP5,
    "op7_mix_sources": OP7,
}


OP11 = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
g AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, m
  FROM (SELECT lang, w, i, unnest(range(1, least(3, len(w) - i + 1) + 1)) AS m
        FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p))
),
f AS (SELECT lang, phrase, m, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2 AND f >= 10),
halves AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM (SELECT c.*, unnest(range(1, m)) AS k FROM c)
),
cuts AS (
  SELECT h.lang, h.phrase, h.a, h.k, fl.f AS l, fr.f AS r, (h.a * h.a * 1000000) // (fl.f * fr.f) AS score
  FROM halves h JOIN f fl ON fl.lang = h.lang AND fl.phrase = h.lp JOIN f fr ON fr.lang = h.lang AND fr.phrase = h.rp
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT lang, array_to_string(w[1:2], ' ') AS part, a FROM c WHERE m = 3
  UNION ALL SELECT lang, array_to_string(w[2:3], ' ') AS part, a FROM c WHERE m = 3
),
kept AS (
  SELECT * FROM best b
  WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.lang = b.lang AND h.part = b.phrase AND 100 * h.a >= 50 * b.a)
),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, score FROM kept
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLES["op11_collocations"] = OP11
