"""DuckDB SQL of the queries that SQL can express, for the tables given."""

from __future__ import annotations

from pitchline.llm.common import LOWER, UPPER
from pitchline.llm.hard_negatives import HIGH, LOW, NEGATIVES, POSITIVES
from pitchline.llm.host_quality import MAX_RATE, SYMBOLS
from pitchline.llm.licenses import BASE, INDEXED, MIN_SCORE, TEMPLATES
from pitchline.llm.repeats import LENGTH

_ROWS = "SELECT row_number() OVER () AS r, doc_id, {columns} FROM documents"

# ------------------------------------------------------------- operator 8

_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP8 = f"""
WITH d AS ({_ROWS.format(columns="COALESCE(source, '') AS host, COALESCE(text, '') AS text")}),
w AS (SELECT r, [x FOR x IN string_split_regex(text, '[\\x20\\x09-\\x0D]+') IF x <> ''] AS words FROM d),
t AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w),
g AS (SELECT r, pos, word || ' ' || LEAD(word) OVER p || ' ' || LEAD(word, 2) OVER p AS three
      FROM t WINDOW p AS (PARTITION BY r ORDER BY pos)),
again AS (SELECT r, pos FROM (SELECT r, pos, count(*) OVER (PARTITION BY r, three) AS n FROM g WHERE three IS NOT NULL) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([pos, pos + 1, pos + 2]) AS p FROM again) GROUP BY r),
l AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
m AS (SELECT d.r, doc_id, host, len(words) AS n_words,
        CAST(length(translate(text, {_SPACE}, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
        COALESCE(n_lines, 0) AS n_lines, COALESCE(n_dup_lines, 0) AS n_dup_lines,
        COALESCE(n_repeat_words, 0) AS n_repeat_words
      FROM d JOIN w USING (r) LEFT JOIN covered USING (r) LEFT JOIN l USING (r)),
f AS (SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
        unnest([{{'rule': 'symbols', 'failed': n_symbols * 10 > n_words}},
                {{'rule': 'lines', 'failed': n_dup_lines * 10 > n_lines * 3}},
                {{'rule': 'length', 'failed': word_chars < n_words * 3 OR word_chars > n_words * 10}}]) AS s FROM m),
h AS (SELECT host, s.rule AS rule, count(*) AS n, count(*) FILTER (WHERE s.failed) AS k FROM f GROUP BY 1, 2),
prior AS (SELECT rule, avg(k / n) AS m, avg(k / n) * (1 - avg(k / n)) AS spread,
            greatest(var_pop(k / n) - avg(k / n) * (1 - avg(k / n)) * avg(1 / n), 0) AS v FROM h GROUP BY rule),
weight AS (SELECT rule, m, least(greatest(CASE WHEN v > 0 THEN spread / v - 1 ELSE 1e6 END, 1), 1e6) AS w FROM prior),
bad AS (SELECT host, rule, (k + m * w) / (n + w) > {MAX_RATE} AS bad FROM h JOIN weight USING (rule))
SELECT any_value(doc_id) AS doc_id, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars,
  any_value(n_symbols) AS n_symbols, any_value(n_dup_lines) AS n_dup_lines, any_value(n_repeat_words) AS n_repeat_words,
  any_value(base_failed) AS base_failed, NOT (any_value(base_failed) OR bool_or(s.failed AND bad)) AS kept, f.host
FROM f JOIN bad ON f.host = bad.host AND s.rule = bad.rule GROUP BY r, f.host"""

# ------------------------------------------------------------- operator 6

_BASE = ", ".join(f"({' AND '.join(f'w{i} = {w!r}' for i, w in enumerate(p.split()))}) AS is_{k}"
                  for k, p in enumerate(BASE))
_ANY = " OR ".join(f"is_{k}" for k in range(len(BASE)))
_COUNT = " + ".join(f"is_{k}::INT" for k in range(len(BASE)))
_LABELS = ", ".join(f"CASE WHEN bool_or(is_{k}) THEN '{label}' END" for k, label in enumerate(BASE.values()))
_TEMPLATE_WORDS = ", ".join(f"({name!r}, {w!r}, {i})" for name, (text, _) in sorted(TEMPLATES.items())
                            for i, w in enumerate(text.split()))
_PHRASES = ", ".join(f"({name!r}, {p!r})" for name, (_, phrases) in sorted(TEMPLATES.items()) for p in phrases)
OP6 = f"""
WITH d AS ({_ROWS.format(columns=f"translate(COALESCE(text, ''), '{UPPER}', '{LOWER}') AS text")}),
w AS (SELECT r, doc_id, [x FOR x IN string_split_regex(text, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> ''] AS words FROM d),
t AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM w),
n AS (SELECT r, pos, word AS w0, COALESCE(LEAD(word) OVER p, '') AS w1, COALESCE(LEAD(word, 2) OVER p, '') AS w2,
        COALESCE(LEAD(word, 3) OVER p, '') AS w3 FROM t WINDOW p AS (PARTITION BY r ORDER BY pos)),
b AS (SELECT r, pos, {_BASE} FROM n),
base AS (SELECT r, CAST(sum({_COUNT}) AS BIGINT) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
           [x FOR x IN [{_LABELS}] IF x IS NOT NULL] AS base FROM b WHERE {_ANY} GROUP BY r),
tw AS (SELECT * FROM (VALUES {_TEMPLATE_WORDS}) v(template, word, tpos)),
phrase AS (SELECT * FROM (VALUES {_PHRASES}) v(template, phrase)),
df AS (SELECT word, count(DISTINCT r) AS df FROM t WHERE word IN (SELECT word FROM tw) GROUP BY word),
idf AS (SELECT DISTINCT word, ln(((SELECT count(*) FROM d) + 1) / (COALESCE(df, 0) + 1)) + 1e-6 AS idf
        FROM tw LEFT JOIN df USING (word)),
rare AS (SELECT template, word, idf FROM (SELECT template, word, idf, row_number() OVER (
           PARTITION BY template ORDER BY idf DESC, word) AS k FROM (SELECT DISTINCT template, word FROM tw) JOIN idf USING (word))
         WHERE k <= {INDEXED}),
posting AS (SELECT template, word, tpos, idf / sum(idf) OVER (PARTITION BY template) AS share FROM tw JOIN rare USING (template, word)),
top AS (SELECT DISTINCT r, word FROM t WHERE word IN (SELECT word FROM rare)),
cand AS (SELECT DISTINCT r, template FROM top JOIN posting USING (word)),
verified AS (SELECT r, template FROM cand JOIN w USING (r) JOIN phrase USING (template) GROUP BY r, template
             HAVING bool_and(contains(' ' || array_to_string(words, ' ') || ' ', ' ' || phrase || ' '))),
shifted AS (SELECT r, template, pos - tpos AS shift, sum(share) AS score FROM t JOIN top USING (r, word)
            JOIN posting USING (word) JOIN verified USING (r, template) GROUP BY 1, 2, 3),
found AS (SELECT r, list(template) AS found, max(score) AS score FROM (
            SELECT r, template, max(score) AS score FROM shifted GROUP BY 1, 2) WHERE score >= {MIN_SCORE} GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, COALESCE(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(COALESCE(base, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(COALESCE(base, []), COALESCE(found, [])))), ',') AS labels,
  round(least(COALESCE(score, 0.0), 1.0), 9) AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN found USING (r)"""

# ------------------------------------------------------------- operator 7

_HEX = 2 * LENGTH
OP7 = f"""
WITH d AS ({_ROWS.format(columns="lower(hex(encode(COALESCE(text, '')))) AS h")}),
p AS (SELECT r, doc_id, h, CAST(length(h) / 2 AS BIGINT) AS n FROM d),
s AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, {_HEX}) AS s FROM (
        SELECT r, doc_id, h, unnest(range(n - {LENGTH} + 1)) AS i FROM p WHERE n >= {LENGTH})),
gone AS (SELECT r, i FROM (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM s) WHERE least < doc_id),
runs AS (SELECT r, i, sum(CASE WHEN i <= before + {LENGTH} THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS run
         FROM (SELECT r, i, COALESCE(LAG(i) OVER (PARTITION BY r ORDER BY i), -1000000) AS before FROM gone)),
spans AS (SELECT r, run, min(i) AS a, max(i) + {LENGTH} AS b FROM runs GROUP BY r, run),
parts AS (SELECT r, a, b, COALESCE(LAG(b) OVER (PARTITION BY r ORDER BY a), 0) AS left_from FROM spans),
kept AS (SELECT r, string_agg(substr(h, 2 * left_from + 1, 2 * (a - left_from)), '' ORDER BY a)
           || substr(any_value(h), 2 * max(b) + 1) AS kept, sum(b - a) AS n_removed, count(*) AS n_spans
         FROM parts JOIN p USING (r) GROUP BY r)
SELECT doc_id, n AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
  sha256(unhex(COALESCE(kept, h))) AS kept_sha256
FROM p LEFT JOIN kept USING (r)"""

# ------------------------------------------------------------ operator 12

OP12 = f"""
WITH r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE same) WHERE k <= {POSITIVES})
SELECT * FROM (
  SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score)
WHERE rank <= {NEGATIVES}"""

# ------------------------------------------------------------ operator 13

# crc32 of the id's digits, bit by bit; a node's prefix is the list of its turns' hashes
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
  lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""
OP13 = f"""
WITH w AS (SELECT conv_id, turn, COALESCE(role, '') AS role, strlen(COALESCE(text, '')) AS size,
             sha256(strlen(COALESCE(role, '')) || ' ' || COALESCE(role, '') || COALESCE(text, '')) AS h
           FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, h, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, h) AS pos FROM w),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base, {_CRC} % 9 AS heads FROM o GROUP BY conv_id),
t AS (SELECT c.*, least(c.heads, COALESCE(b.n, 0)) AS taken FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (SELECT t.conv_id, pos AS d, h, size FROM t JOIN o ON o.conv_id = t.base AND pos <= taken
      UNION ALL SELECT t.conv_id, taken + pos - heads, h, size FROM t JOIN o USING (conv_id) WHERE pos > heads),
s AS (SELECT t.conv_id, COALESCE(list(h ORDER BY d) FILTER (WHERE d IS NOT NULL), []) AS turns,
        COALESCE(list(size ORDER BY d) FILTER (WHERE d IS NOT NULL), []) AS sizes FROM t LEFT JOIN r USING (conv_id) GROUP BY t.conv_id),
p AS (SELECT conv_id, len(turns) AS length, d, array_to_string(turns[1:d], ',') AS prefix,
        CASE WHEN d > 0 THEN array_to_string(list_slice(turns, 1, d - 1), ',') END AS parent, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
      FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM s)),
g AS (SELECT prefix, d, any_value(parent) AS parent, any_value(size) AS size, min(conv_id) AS low, count(*) AS n,
        COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length = d), '') AS ends FROM p GROUP BY prefix, d),
k AS (SELECT parent AS prefix, d - 1 AS d, count(*) AS children FROM g WHERE d > 0 GROUP BY 1, 2),
u AS (SELECT a.prefix, a.d, count(*) FILTER (WHERE children IS NULL) AS leaves, sum((x.n - 1) * x.size) AS saved
      FROM g x LEFT JOIN k USING (prefix, d) JOIN p a ON a.conv_id = x.low AND a.d <= x.d GROUP BY 1, 2)
SELECT g.low AS conv_id, g.d AS depth, up.low AS parent_conv_id, g.n AS n_convs, COALESCE(children, 0) AS n_children,
  leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(g.ends) AS ends_sha256
FROM g JOIN u USING (prefix, d) LEFT JOIN k USING (prefix, d) LEFT JOIN g up ON up.prefix = g.parent AND up.d = g.d - 1"""

ORACLE = {"op6_license_scan": OP6, "op7_maximal_repeats": OP7, "op8_host_quality": OP8,
          "op12_hard_negatives": OP12, "op13_prefix_trie": OP13}
