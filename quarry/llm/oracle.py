"""DuckDB SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

from quarry.llm.chat import CONTROLS, LOSS_ROLE, OPENINGS, OTHER, ROLE_END, TURN_END
from quarry.llm.quality_rules import BIT, DEFAULT_POLICY, policy_mask


def _q(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


_CORE = "|".join(c.strip().replace("#", "[#]") for c in CONTROLS)
_ESCAPED = "regexp_replace({0}, '\\\\*(" + _CORE + ")', '\\\\\\0', 'g')"
_OPEN = " ".join(f"WHEN role = '{r}' THEN {len(c)}" for r, c in OPENINGS.items())

OP1 = f"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = '{LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{LOSS_ROLE}'), '')) AS loss_sha256,
       CAST(sum(CASE {_OPEN} ELSE {len(OTHER) + len(ROLE_END)} + length({_ESCAPED.format('role')}) END
                + length({_ESCAPED.format('text')}) + {len(TURN_END)}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP4 = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
    SELECT a AS s, b AS t FROM links
    UNION SELECT r.s, l.b FROM reach r JOIN links l ON l.a = r.t)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(m.t, e.vec_id)) AS component_id,
       least(e.vec_id, coalesce(m.t, e.vec_id)) = e.vec_id AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
LEFT JOIN (SELECT s, min(t) AS t FROM reach GROUP BY s) m ON m.s = e.vec_id
"""

_WORDS = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"
_MEASURES = f"""
d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS words FROM documents),
w AS (SELECT row, generate_subscripts(words, 1) AS pos, unnest(words) AS word FROM d),
g AS (SELECT row, pos, CASE WHEN lead(word, 4) OVER o IS NULL THEN NULL
             ELSE concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) END AS gram
      FROM w WINDOW o AS (PARTITION BY row ORDER BY pos)),
r AS (SELECT row, pos, gram IS NOT NULL AND count(*) OVER (PARTITION BY row, gram) > 1 AS rep FROM g),
c AS (SELECT row, pos, bool_or(rep) OVER (PARTITION BY row ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS cov FROM r),
n AS (SELECT row, count(*) FILTER (cov) AS n_repeat_words FROM c GROUP BY row),
l AS (SELECT row, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY row),
m AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
             len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\\x00-\\x7F]'))) AS n_letter_words,
             len(list_filter(words, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_upper_words,
             length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclaims
      FROM d LEFT JOIN n USING (row) LEFT JOIN k USING (row)),
f AS (SELECT *, CAST((n_words < 10)::INT * {BIT['few_words']} + (100 * n_repeat_words > 20 * n_words)::INT * {BIT['repeated_words']}
             + (100 * n_symbols > 15 * n_words)::INT * {BIT['symbols']} + (100 * n_upper_words > 40 * n_words)::INT * {BIT['upper_case']}
             + (100 * n_exclaims > 30 * n_words)::INT * {BIT['exclamations']} + (100 * n_letter_words < 60 * n_words)::INT * {BIT['few_letters']}
             + (n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines)::INT * {BIT['duplicate_lines']}
             + (word_chars < 2 * n_words OR word_chars > 40 * n_words)::INT * {BIT['word_length']} AS BIGINT) AS failed_bits FROM m)
"""

OP5 = f"""
WITH {_MEASURES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       failed_bits & {policy_mask(DEFAULT_POLICY)} = 0 AS kept, failed_bits FROM f
"""

ABLATIONS = f"""
WITH {_MEASURES},
rules AS (SELECT unnest([{', '.join(f"'{r}'" for r in BIT)}]) AS rule, unnest([{', '.join(str(b) for b in BIT.values())}]) AS bit)
SELECT rule, count(*) FILTER (failed_bits & bit <> 0) AS n_failed,
       count(*) FILTER (failed_bits & {policy_mask(DEFAULT_POLICY)} = bit) AS n_only FROM rules LEFT JOIN f ON true GROUP BY rule
"""

OP7 = """
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (
    SELECT DISTINCT doc_id, hash(array_to_string(list_slice(words, i, i + 4), ' ')) AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM d WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
    SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both FROM s x JOIN s y USING (shingle)
                          WHERE x.doc_id <> y.doc_id GROUP BY 1, 2) p
    JOIN n u ON u.doc_id = p.a JOIN n v ON v.doc_id = p.b WHERE 100 * p.both >= 75 * (u.n + v.n - p.both)),
reach AS (SELECT a AS s, b AS t FROM links UNION SELECT r.s, l.b FROM reach r JOIN links l ON l.a = r.t)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.t, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(m.t, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT s, min(t) AS t FROM reach GROUP BY s) m ON m.s = d.doc_id
"""

OP11 = """
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents),
w AS (SELECT row, lang, source, unnest(words) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
l AS (SELECT lang, sum(n) AS n, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT lang, source, sum(c.n) AS n FROM (SELECT DISTINCT lang, source FROM d)
      LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL) c USING (lang, source) GROUP BY lang, source),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5) // (coalesce(g.n, 0) + 5 * l.v) AS p,
             1 + CAST(1000000000 AS HUGEINT) * (k.n + 5) // (l.n + 5 * l.v) AS q
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER o AS INTEGER) AS rank FROM r
WINDOW o AS (PARTITION BY lang, source, part ORDER BY value DESC, item) QUALIFY part = 'pair' OR row_number() OVER o <= 50
"""

OP13 = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id AS other, a.label = v.label AS same, CAST(list_inner_product(a.e, v.e) AS BIGINT) AS score
      FROM a JOIN v ON a.vec_id <> v.vec_id OR a.label <> v.label),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER o AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW o AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER o <= 10
"""

ORACLE = {"op1_chat_format": OP1, "op4_vectors": OP4, "op5_quality_rules": OP5, "op7_minhash": OP7, "op11_source_divergence": OP11, "op13_hard_negatives": OP13, "quality_ablations": ABLATIONS}
