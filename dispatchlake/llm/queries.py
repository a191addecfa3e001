"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import license_scan, sharding
from .decontaminate import op6_decontamination
from .divergence import op13_source_divergence
from .license_scan import op10_license_scan
from .mixing import op9_mixing
from .neighbours import op8_neighbours
from .packing import op12_best_fit_packing
from .secret_scan import op3_secret_scan
from .sharding import op4_sharding
from .similar_sets import op5_ngram_jaccard
from .spelling import op11_spelling_variants
from .substring_dedup import op1_substring_dedup
from .token_counts import op7_token_counts
from .toxicity import op2_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_secret_scan": op3_secret_scan,
    "op4_sharding": op4_sharding,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_decontamination": op6_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_neighbours": op8_neighbours,
    "op9_mixing": op9_mixing,
    "op10_license_scan": op10_license_scan,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_source_divergence": op13_source_divergence,
}

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_LOWER_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_ALNUM = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


def _templates() -> str:
    """The license scan's phrases and texts, words only, as rows of VALUES."""
    plain = lambda t: " ".join(re.findall(r"[0-9a-z]+", t.lower()))
    rows = [(label, True, license_scan.BASE_GRAM, t) for label, t in license_scan.BASE] + [(label, False, license_scan.GRAM, plain(t)) for label, t in license_scan.TEXTS]
    return ", ".join(f"({n}, '{label}', {base}, {k}, '{t}')" for n, (label, base, k, t) in enumerate(rows))


ORACLE_SQL: dict[str, str] = {
    "op11_spelling_variants": r"""
WITH RECURSIVE steps AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i)
),
runs AS (
  SELECT id, run, count(*) AS n FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
  ) WHERE length(run) >= 7 GROUP BY id, run
),
sums AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8)
  )) AS h FROM (SELECT run, n, hex(id || ':' || run) AS x FROM runs), steps
),
k AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM sums
  ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM k)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, k.word, k.n FROM less a JOIN k ON k.word = a.rest
  UNION SELECT k.word, a.word, a.n FROM less a JOIN k ON k.word = a.rest
),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM pairs GROUP BY word),
forms AS (
  SELECT word, k.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 10 * k.n THEN other END AS form, CASE WHEN other_n >= 10 * k.n THEN other_n END AS form_n
  FROM k LEFT JOIN best USING (word)
),
chain AS (
  SELECT word, word AS place FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.place WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.place AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c USING (word) JOIN forms e ON e.word = c.place AND e.form IS NULL
""",
    "op13_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
),
words AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n_lang FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
counts AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(n_lang) AS n FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN counts USING (lang, source) GROUP BY ALL
),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c, 0) + 5)) // (g.n + 5 * v)::HUGEINT AS p, 1 + (1000000000::HUGEINT * (n_lang + 5)) // (l.n + 5 * v)::HUGEINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts USING (lang, source, term)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
told AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value FROM pairs LEFT JOIN apart USING (lang, source, item)
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE c > 0 AND p > q
)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM told)
WHERE part = 'pair' OR rank <= 50
""",
    "op10_license_scan": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
t AS (SELECT *, string_split(x, ' ') AS w FROM (VALUES {_templates()}) AS v(template, label, base, k, x)),
places AS (
  SELECT template, label, base, k, grams, q, array_to_string(w[q + 1 : q + k], ' ') AS g
  FROM (SELECT *, len(w) - k + 1 AS grams, unnest(range(0, len(w) - k + 1)) AS q FROM t)
),
grams AS (
  SELECT r, k, p, array_to_string(w[p + 1 : p + k], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(0, len(w) - k + 1)) AS p FROM d, (VALUES (2), (4)) AS ks(k) WHERE len(w) >= k)
),
votes AS (SELECT r, template, label, base, places.grams AS n, p, q, p - q AS diagonal FROM grams JOIN places USING (k, g)),
base AS (SELECT r, label, diagonal FROM votes WHERE base GROUP BY r, template, label, n, diagonal HAVING count(*) = n),
merged AS (
  SELECT a.r, a.template, a.label, a.n, a.diagonal, v.q, min(v.p) AS p
  FROM (SELECT DISTINCT r, template, label, n, diagonal FROM votes WHERE NOT base) a
  JOIN votes v ON v.r = a.r AND v.template = a.template AND v.diagonal BETWEEN a.diagonal AND a.diagonal + {license_scan.DRIFT}
  GROUP BY ALL
),
ordered AS (
  SELECT *, p > coalesce(max(p) OVER (PARTITION BY r, template, diagonal ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS fits FROM merged
),
spans AS (SELECT r, label, count(*) FILTER (WHERE fits) / n AS share FROM ordered GROUP BY r, template, label, n, diagonal),
told AS (
  SELECT r, label, diagonal, 1.0::DOUBLE AS share, true AS base FROM base
  UNION ALL SELECT r, label, NULL, share, false FROM spans
),
texts AS (
  SELECT r, count(*) FILTER (WHERE base) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word, max(share) AS score,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base OR share >= {license_scan.COVERED}) AS labels
  FROM told GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN texts USING (r)
""",
    "op1_substring_dedup": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT r, p, md5(array_to_string(w[p : p + 34], ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d)
),
repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
starts AS (SELECT r, p FROM windows WHERE h IN (SELECT h FROM repeated)),
placed AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
covered AS (
  SELECT x.r, x.p, x.word, max(s.p) OVER (PARTITION BY x.r ORDER BY x.p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM placed x LEFT JOIN starts s ON s.r = x.r AND s.p = x.p
),
texts AS (
  SELECT r, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept
  FROM covered GROUP BY r
)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN texts USING (r)
""",
    "op6_decontamination": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
items AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[p : p + least(len(w), 13) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM items WHERE len(w) > 0)
),
grams AS (
  SELECT r, k, p, array_to_string(w[p : p + k - 1], ' ') AS x
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
),
hits AS (SELECT r, k, p, item_id FROM grams JOIN windows USING (k, x)),
hit_words AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + k)) AS q FROM hits) GROUP BY r),
hit_items AS (SELECT r, count(*) AS n, string_agg(i, ',' ORDER BY i) AS list FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
  sha256(coalesce(i.list, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words h USING (r) LEFT JOIN hit_items i USING (r)
""",
    "op9_mixing": rf"""
WITH keyed AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
    md5(concat_ws(chr(31), coalesce('+' || doc_id::VARCHAR, '-'), coalesce(md5(text), '-'), coalesce('+' || source, '-'))) AS key
  FROM documents
),
d AS (
  SELECT doc_id, source, size, ('0x' || substr(md5(key || ':' || row_number() OVER (PARTITION BY key)), 1, 15))::BIGINT >> 24 AS prefix FROM keyed
),
s AS (
  SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)
),
filling AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER f, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS open_weight
  FROM s WINDOW f AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
marked AS (SELECT *, 3 * source_size * open_weight <= weight * rest AS full_up FROM filling),
level AS (SELECT min_by(rest, source_size / weight) AS rest, min_by(open_weight, source_size / weight) AS open_weight FROM marked WHERE NOT full_up),
wanted AS (
  SELECT source, source_size, CASE WHEN full_up THEN (3 * source_size)::DOUBLE ELSE level.rest::DOUBLE * weight / level.open_weight::DOUBLE END AS target
  FROM marked LEFT JOIN level ON true
),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM wanted
),
buckets AS (SELECT source, prefix, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY prefix) AS until FROM d GROUP BY source, prefix),
edge AS (
  SELECT b.source, min_by(x.prefix + CASE WHEN 2 * ((b.target - b.passes * b.source_size) - (x.until - x.words)) > x.words THEN 1 ELSE 0 END, x.prefix) AS threshold
  FROM budgets b JOIN buckets x ON x.source IS NOT DISTINCT FROM b.source AND x.until > b.target - b.passes * b.source_size GROUP BY b.source
)
SELECT doc_id, size, source_size, target, (size * (passes + CASE WHEN prefix < coalesce(threshold, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source LEFT JOIN edge e ON e.source IS NOT DISTINCT FROM b.source
""",
    "op4_sharding": f"""
SELECT doc_id, slot, ('0x' || substr('{"".join(f"{i:04x}" for i in sharding.fill())}', slot * 4 + 1, 4))::INTEGER AS shard
FROM (SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {sharding.SLOTS})::INTEGER AS slot FROM documents)
""",
    "op5_ngram_jaccard": rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[p : p + least(len(w), 4) - 1], ' ')) AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS p FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS c FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.c)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(c) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id
""",
}
