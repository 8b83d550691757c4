"""The operators that SQL can express, for DuckDB."""

from sensorloom.llm import licenses, secrets

EXACT_DEDUP = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM n JOIN g USING (norm)
"""

NEAR_DEDUP = r"""
WITH RECURSIVE low AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, [x for x in string_split_regex(t, '[\x20\x09-\x0D]+') if x <> ''] AS words FROM low),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) BETWEEN 1 AND 4 THEN [array_to_string(words, ' ')]
    ELSE [array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)] END) AS shingle FROM w),
n AS (SELECT doc_id, count(shingle) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY doc_id),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s AS a JOIN s AS b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM c JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
  WHERE 100 * common >= 85 * (x.n + y.n - common)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, n AS n_shingles, min(r.b) AS component_id, doc_id = min(r.b) AS kept
FROM n JOIN r ON r.a = doc_id GROUP BY doc_id, n
"""

FILTER_AUDIT = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    [x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS w FROM documents),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, good, toxic, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
    100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails FROM d LEFT JOIN l USING (doc_id)),
c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY ALL),
o AS (
  SELECT '' AS filter_order UNION ALL SELECT filter_order || x FROM o, unnest(['A', 'B', 'C', 'D', 'E']) AS u(x)
  WHERE NOT contains(filter_order, x)),
s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, [ascii(x) - 64 for x in string_split(filter_order, '')] AS idx
  FROM o, range(1, 6) AS r(step) WHERE length(filter_order) = 5),
j AS (
  SELECT c.*, filter_order, step, f, fails[idx[step]] AS own, len([i for i in idx[1:step - 1] if fails[i]]) > 0 AS gone,
    len([x for x in fails if x]) AS failed FROM c CROSS JOIN s),
r AS (
  SELECT part, filter_order, step, f, sum(n) FILTER (NOT own AND NOT gone) AS kept, sum(n) FILTER (own AND NOT gone) AS removed,
    sum(n) FILTER (own AND gone) AS redundant, sum(n) FILTER (own AND failed = 1) AS unique_fails,
    sum(good) FILTER (own AND NOT gone) AS good_lost, sum(toxic) FILTER (own AND NOT gone) AS toxic_lost
  FROM j GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
  CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""

PHRASES = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (
  SELECT row_number() OVER () AS piece, lang, [x for x in string_split_regex(piece, '[\x20\x09]+') if x <> ''] AS w FROM p),
i AS (SELECT piece, lang, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0),
n AS (SELECT lang, count(*) AS n FROM i GROUP BY lang),
g AS (
  SELECT lang, x, x || ' ' || lead(x) OVER o AS x2, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o AS x3,
    x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o AS x4
  FROM i WINDOW o AS (PARTITION BY piece ORDER BY i)),
q AS (
  SELECT lang, x AS phrase, 1 AS k FROM g UNION ALL SELECT lang, x2, 2 FROM g UNION ALL SELECT lang, x3, 3 FROM g
  UNION ALL SELECT lang, x4, 4 FROM g),
f AS (
  SELECT lang, string_split(phrase, ' ') AS ws, k, count(*) AS a FROM q WHERE phrase IS NOT NULL GROUP BY lang, phrase, k
  HAVING count(*) >= 30),
x AS (
  SELECT f.lang, f.ws, f.a, c.k, l.a AS l, r.a AS r, 2000000::HUGEINT * f.a // (l.a + r.a) AS score
  FROM f JOIN range(1, 4) AS c(k) ON c.k < f.k JOIN f AS l ON l.lang = f.lang AND l.ws = f.ws[1:c.k]
  JOIN f AS r ON r.lang = f.lang AND r.ws = f.ws[c.k + 1:]),
s AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
h AS (
  SELECT lang, ws[b:b + len - 1] AS ws, max(a) AS longer FROM f, range(2, 4) AS t(len), range(1, 4) AS u(b)
  WHERE len < f.k AND b + len - 1 <= f.k GROUP BY ALL),
t AS (
  SELECT s.lang, array_to_string(s.ws, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score
  FROM s LEFT JOIN h ON h.lang = s.lang AND h.ws = s.ws WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM t)
SELECT lang, rank, phrase, a, l, r, n, score FROM k JOIN n USING (lang) WHERE rank <= 2000
"""

NEAR_VECTORS = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len([x for x in e if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in e if x <> 0]) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u AS a JOIN u AS b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
n AS (SELECT vec_id, count(b) AS n_links FROM v LEFT JOIN l ON a = vec_id GROUP BY vec_id),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT vec_id, n_links, min(r.b) AS component_id, vec_id = min(r.b) AS kept FROM n JOIN r ON r.a = vec_id GROUP BY vec_id, n_links
"""


def _found(rank: int, pattern: str, group: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {rank} AS rank, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS found,
         regexp_extract_all(t, '{pattern}', {group}) AS vals FROM d WHERE regexp_matches(t, '{pattern}')"""


def secret_scan() -> str:
    """Places from the lengths of gaps and matches; entropy window by window."""
    patterns = [*secrets.RULES.values(), secrets.CANDIDATE]
    found = " UNION ALL ".join(_found(i, p, 1 if i == 0 else 0) for i, p in enumerate(patterns))
    fits = lambda patterns: " AND ".join(f"regexp_matches(v, '{p}')" for p in patterns)
    least = " ".join(f"WHEN {fits(patterns)} THEN {bits}" for patterns, bits in secrets.CLASSES.values())
    window, kinds = secrets.WINDOW, ", ".join(f"'{k}'" for k in secrets.KINDS)
    text = lambda condition: f"""coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e)
    FILTER ({condition}), '')"""  # noqa: E731
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({found}),
i AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m),
p AS (
  SELECT doc_id, rank, vals[i] AS v, length(found[i]) AS n, list_sum([length(x) for x in gaps[1:i]])
    + coalesce(list_sum([length(x) for x in found[1:i - 1]]), 0) AS s FROM i),
base AS (SELECT doc_id, rank, s, s + n AS e FROM p WHERE rank < 3 AND (rank > 0 OR length(v) >= {secrets.MIN_VALUE})),
cand AS (
  SELECT *, CASE {least} END AS least
  FROM p WHERE rank = 3 AND NOT regexp_matches(v, '{secrets.ALLOWED}')
    AND NOT EXISTS (FROM base AS b WHERE b.doc_id = p.doc_id AND b.s < p.s + p.n AND b.e > p.s)),
wins AS (SELECT doc_id, s, v, least, unnest(range(1, n - {window - 2})) AS k FROM cand WHERE least IS NOT NULL),
high AS (
  SELECT doc_id, s + min(k) - 1 AS s, s + max(k) - 1 + {window} AS e FROM wins
  WHERE list_aggregate(string_split(substr(v, k, {window}), ''), 'entropy') >= least - 1e-9 GROUP BY doc_id, wins.s),
spans AS (SELECT doc_id, rank, s, e FROM base UNION ALL SELECT doc_id, 3, s, e FROM high),
named AS (SELECT *, list_value({kinds})[rank + 1] AS kind FROM spans)
SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
  sha256({text("rank < 3")}) AS base_sha256, {text("rank IS NOT NULL")} AS spans, count(*) FILTER (rank = 3) AS n_entropy
FROM d LEFT JOIN named USING (doc_id) GROUP BY doc_id
"""


def license_scan() -> str:
    """Pieces end with chr(2) and start with chr(1), so that neighbours share no mark."""
    gap = r"(?: |\x02\x01)"
    rows = lambda pairs: ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(pairs))
    rules = rows((name, "," + ",".join(ids) + ",") for name, ids in licenses.RULES)
    return rf"""
WITH RECURSIVE rules(i, name, sequence) AS (VALUES {rules}),
known(i, sentence, id) AS (VALUES {rows(licenses.known().items())}),
book AS (SELECT map(list(sentence), list(id)) AS ids FROM known),
l AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS n FROM documents),
g AS (SELECT * FROM l WHERE regexp_matches(t, '{licenses.MENTIONS}')),
a AS (
  SELECT n, array_to_string([CASE WHEN contains(x, 'SPDX-License-Identifier:') THEN regexp_replace(
    regexp_replace(x, '([0-9])\+', '\1-or-later', 'g'), '\x20+(?:OR|AND|WITH)\x20+', chr(10) || 'SPDX-License-Identifier: ', 'g')
    ELSE x END for x in string_split(t, chr(10))], chr(10)) AS t FROM g),
b AS (SELECT n, regexp_replace(lower(t), '\n[\x20\x09-\x0D]*\n[\x20\x09-\x0D]*', chr(10) || chr(10), 'g') AS t FROM a),
c AS (SELECT n, regexp_replace(t, '[\x20\x09\x0B-\x0D]+\n', chr(10), 'g') AS t FROM b),
d AS (SELECT n, regexp_replace(t, '([.;:!?])[\x20\x09\x0B-\x0D]+', '\1' || chr(10), 'g') AS t FROM c),
e AS (SELECT n, regexp_replace(t, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS t FROM d),
p AS (SELECT n, [trim(x, ' ') for x in string_split(t, chr(10))] AS p FROM e),
j AS (SELECT n, chr(1) || array_to_string(p, chr(2) || chr(1)) || chr(2) AS t FROM p),
f AS (SELECT n, regexp_extract_all(t, '\x01({licenses.either(gap)})\x02', 1) AS found FROM j),
k AS (SELECT n, [ids[regexp_replace(replace(x, chr(2) || chr(1), ' '), '^{licenses.opening()}', '{licenses.OPENING}')] for x in found] AS ids FROM f, book WHERE len(found) > 0),
m AS (
  SELECT n, -1 AS i, ',' || array_to_string(ids, ',') || ',' AS rest, [] :: VARCHAR[] AS names FROM k UNION ALL
  SELECT n, r.i, replace(replace(rest, sequence, ',-,'), sequence, ',-,'),
    CASE WHEN contains(rest, sequence) AND NOT list_contains(names, name) THEN list_append(names, name) ELSE names END
  FROM m JOIN rules AS r ON r.i = m.i + 1),
z AS (SELECT * FROM m WHERE i = {len(licenses.RULES) - 1})
SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids, coalesce(array_to_string(names, ','), '') AS licenses,
  coalesce(len(ids), 0) :: BIGINT AS n_sentences,
  coalesce(len([x for x in string_split(rest, ',') if x NOT IN ('', '-')]), 0) :: BIGINT AS n_unmatched
FROM l LEFT JOIN k USING (n) LEFT JOIN z USING (n)
"""
