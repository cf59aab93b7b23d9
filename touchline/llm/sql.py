"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from touchline.llm import hard_negatives, metric_join, mixing, quality

_SPACES = "[ \\t-\\r]+"
_WORDS = "[^ \\t-\\r]+"

EXACT = f"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)"""

#: Sources in the order in which they fill up: with the first j closed, the rest is poured to level (budget - closed) / weights.
MIX = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source),
w AS (SELECT *, CASE r % 3 WHEN 0 THEN {mixing.WEIGHTS[0]} WHEN 1 THEN {mixing.WEIGHTS[1]} ELSE {mixing.WEIGHTS[2]} END AS weight FROM s),
o AS (SELECT *, {mixing.MOST} * source_size AS most, {mixing.SHARE} * sum(source_size) OVER () AS budget,
  row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS j FROM w),
l AS (SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
f AS (SELECT coalesce(arg_min(level, j) FILTER (weight * level < most), 0) AS level FROM l),
t AS (SELECT source, source_size, least(CAST(most AS DOUBLE), weight * CAST(f.level AS DOUBLE)) AS target FROM l, f),
p AS (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
  CAST(CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM p"""


def _quality() -> str:
    grids = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, {rule} AS metric, stratum, doc_id, unnest([{', '.join(map(str, grid))}]) AS cut FROM good"
        for rule, grid in quality.GRID.items()
    )
    fires = " OR ".join(f"coalesce({rule} > {rule}_cut, false)" for rule in quality.GRID)
    pivot = ", ".join(f"min(cut) FILTER (rule = '{rule}') AS {rule}_cut" for rule in quality.GRID)
    rate = quality.FALSE_REJECTION / len(quality.GRID)
    tests = sum(len(grid) for grid in quality.GRID.values())
    w = quality.WINDOW
    return f"""
WITH d AS (SELECT doc_id, lang AS stratum, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS words,
  [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '{_WORDS}')] AS lines FROM documents),
i AS (SELECT doc_id, words, unnest(range(1, len(words) - {w - 2})) AS i FROM d WHERE len(words) >= {w}),
win AS (SELECT doc_id, i, array_to_string(words[i:i + {w - 1}], ' ') AS win FROM i),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, sum(least({w}, coalesce(nxt - i, {w}))) AS n FROM
  (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
f AS (SELECT d.doc_id, stratum, array_to_string(words, ' ') AS copy, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '{quality.SYMBOLS}')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
  CAST(len(lines) AS BIGINT) AS n_lines FROM d LEFT JOIN cov USING (doc_id)),
m AS (SELECT *, CASE WHEN n_words > 0 THEN CAST(n_symbols AS DOUBLE) / n_words ELSE 0 END AS symbols_per_word,
  CASE WHEN n_lines > 0 THEN CAST(n_dup_lines AS DOUBLE) / n_lines ELSE 0 END AS dup_line_share,
  CASE WHEN n_words > 0 THEN CAST(n_repeat_words AS DOUBLE) / n_words ELSE 0 END AS repeat_share,
  CASE WHEN n_words > 0 THEN CAST(word_chars AS DOUBLE) / n_words ELSE 0 END AS mean_word_chars FROM f),
good AS (SELECT DISTINCT ON (stratum, copy) m.* FROM m JOIN (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) > 0) USING (doc_id)
  ORDER BY stratum, copy, doc_id),
g AS ({grids}),
c AS (SELECT rule, stratum, cut, count(*) AS n, count(*) FILTER (metric > cut) AS k FROM g GROUP BY rule, stratum, cut),
p AS (SELECT *, CASE WHEN k < n * {rate!r} THEN list_sum([exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1)
    + x * ln({rate!r}) + (n - x) * ln(1 - {rate!r})) for x in range(0, k + 1)]) ELSE 1 END AS tail,
  (SELECT count(*) FROM (SELECT DISTINCT stratum FROM good)) AS strata FROM c),
t AS (SELECT stratum, {pivot} FROM p WHERE tail <= {quality.ALPHA} / (strata * {tests}) GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT fires AS kept FROM (
  SELECT m.*, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed, {fires} AS fires
  FROM m LEFT JOIN t ON m.stratum IS NOT DISTINCT FROM t.stratum)"""


#: Pairs of one label by their cosine, and what can be reached over them.
NEAR_VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT DISTINCT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_cosine_similarity(a.e, b.e) >= {metric_join.COSINE}),
r AS (SELECT DISTINCT vec_id AS a, vec_id AS b FROM ok UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept
FROM v LEFT JOIN n ON v.vec_id = n.a LEFT JOIN c ON v.vec_id = c.a"""

_H = hard_negatives
HARD_NEGATIVES = f"""
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL
  AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND len(a.e) = len(b.e)),
p AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {_H.POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE s.label <> p.own AND {_H.LOW} * positive_score <= 100 * score AND 100 * score <= {_H.HIGH} * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= {_H.NEGATIVES}"""

ORACLES = {
    "op4_quality_rules": _quality(), "op5_exact_dedup": EXACT, "op9_mixing": MIX, "op12_metric_join": NEAR_VECTORS,
    "op13_hard_negatives": HARD_NEGATIVES,
}
