"""The same results in SQL (DuckDB), for the operators that SQL can express.

Written by hand from the operators' definitions; nothing is shared with their code.
"""

QUALITY = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             string_split(text, chr(10)) AS lines FROM t),
l AS (SELECT *, list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS worded FROM w),
e AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w),
g AS (SELECT doc_id, pos, word, lead(word) OVER d AS w2, lead(word, 2) OVER d AS w3
      FROM e WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
c AS (SELECT doc_id, pos, w3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, word, w2, w3) > 1 AS again FROM g),
r AS (SELECT doc_id, count(*) FILTER (covered) AS n_repeat_words FROM (
        SELECT doc_id, max(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered
        FROM c) GROUP BY doc_id),
m AS (SELECT l.doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(worded) - len(list_distinct(worded)) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, len(worded) AS n_lines,
             len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '[a-z]')) AS n_lower,
             len(regexp_extract_all(text, '!')) AS n_shouts,
             len(list_filter(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[a-z0-9\x{80}-\x{10FFFF}]+'),
                 lambda x: x IN ('clown', 'clowns', 'disgusting', 'idiot', 'idiots', 'loser', 'losers', 'moron', 'morons',
                            'pathetic', 'scum', 'stupid', 'trash', 'worthless'))) AS n_abuse
      FROM l LEFT JOIN r USING (doc_id)),
b AS (SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
             + 4 * (100 * n_symbols > 2 * word_chars)::BIGINT
             + 8 * (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines)::BIGINT + 16 * (n_upper > n_lower)::BIGINT
             + 32 * (100 * n_shouts > 10 * n_words)::BIGINT + 64 * (word_chars > 20 * n_words)::BIGINT
             + 128 * (n_abuse >= 2 OR 200 * n_abuse > n_words)::BIGINT AS failed_bits FROM m)
SELECT *, failed_bits & 3 != 0 AS base_failed, failed_bits = 0 AS kept FROM b
"""

ABLATIONS = f"""
WITH q AS ({QUALITY}),
p(policy, version, mask) AS (VALUES ('base', 1, 3), ('web', 1, 15), ('web', 2, 255)),
r(rule, bit) AS (VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('repeated_lines', 8), ('upper_case', 16),
                        ('shouting', 32), ('long_words', 64), ('abuse', 128))
SELECT policy, version, rule, count(*) FILTER (failed_bits & bit != 0) AS fails, count(*) FILTER (failed_bits & mask = bit) AS only_here,
       count(*) FILTER (failed_bits & mask & ~bit = 0) AS kept_without
FROM p JOIN r ON mask & bit != 0 CROSS JOIN q GROUP BY policy, version, rule
"""

MIX = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1)::BIGINT AS place
      FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][place % 3 + 1] AS weight, 2 * source_size AS most FROM s),
o AS (SELECT *, coalesce(sum(most) OVER (ORDER BY most::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
             sum(weight) OVER (ORDER BY most::DOUBLE / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
             sum(source_size) OVER () * 1.5::DOUBLE AS whole FROM w),
p AS (SELECT max((whole - held) / open) FILTER (weight * ((whole - held) / open) <= most) AS per_weight FROM o),
t AS (SELECT source, place, source_size, least(most::DOUBLE, weight * coalesce(per_weight, 0)) AS target FROM o, p),
q AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.place,
             md5(coalesce(d.doc_id::VARCHAR, '') || ':mix-1') AS k FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
a AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY place ORDER BY k, doc_id, size
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead,
             CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM q),
f AS (SELECT *, passes * size + greatest(0, least(size, round(target - passes * source_size)::BIGINT - ahead)) AS taken,
             [1.0, 1.0, 1.0][place % 3 + 1]::DOUBLE AS x, [1.5, 0.5, 1.0][place % 3 + 1]::DOUBLE AS y FROM a),
z AS (SELECT *, CASE WHEN target > 0 THEN least(1.0::DOUBLE, ahead / target) ELSE 0.0 END * (x + y) / 2 AS z FROM f)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
       CASE WHEN taken > 0 THEN 2 * z / (x + sqrt(greatest(0.0::DOUBLE, x * x + 2 * (y - x) * z))) END AS first_position FROM z
"""

NEAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) >= 5
        THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END)) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.size + y.size - shared)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT c.doc_id, coalesce(n.size, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

REPEATS = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS run
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)),
f AS (SELECT run, min(doc_id) AS first FROM g GROUP BY run),
h AS (SELECT doc_id, i FROM g JOIN f USING (run) WHERE first < doc_id),
c AS (SELECT DISTINCT doc_id, i + k AS pos FROM h, (SELECT unnest(range(0, 13)) AS k)),
e AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w),
k AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.pos) FILTER (c.pos IS NULL) AS kept, count(c.pos) AS n_removed
      FROM e LEFT JOIN c ON e.doc_id = c.doc_id AND e.pos = c.pos GROUP BY e.doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

DIVERGENCE = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
t AS (SELECT lang, source, doc, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
v AS (SELECT lang, count(*) AS terms, sum(lang_n) AS size FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, coalesce(size, 0) AS size FROM (SELECT DISTINCT lang, source FROM d)
      LEFT JOIN (SELECT lang, source, sum(n) AS size FROM c GROUP BY lang, source) USING (lang, source)),
x AS (SELECT g.lang, g.source, term, coalesce(n, 0) AS n,
             1 + (1000000000 * (coalesce(n, 0) + 5)::HUGEINT) // (g.size + 5 * v.terms)::HUGEINT AS p,
             1 + (1000000000 * (lang_n + 5)::HUGEINT) // (v.size + 5 * v.terms)::HUGEINT AS q
      FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM x a JOIN x b USING (lang, term) GROUP BY ALL),
p AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
f AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM x WHERE n > 0 AND p > q),
r AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank
      FROM (FROM p UNION ALL FROM f))
SELECT * FROM r WHERE part = 'pair' OR rank <= 50
"""

NEGATIVES = r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

ORACLES = {
    "op1_quality_rules": QUALITY,
    "rule_ablations": ABLATIONS,
    "op6_minhash_dedup": NEAR,
    "op7_substring_dedup": REPEATS,
    "op10_source_mix": MIX,
    "op12_source_divergence": DIVERGENCE,
    "op13_hard_negatives": NEGATIVES,
}
