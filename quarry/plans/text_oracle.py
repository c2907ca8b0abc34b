"""DuckDB SQL for the text queries; the patterns are written out here, not taken from the Spark side."""

from __future__ import annotations

from html.entities import name2codepoint

from quarry.plans import text_queries as Q
from quarry.sources.standins import GROUP_BUCKETS, GROUPS_KEPT, HOST_REGEX, NEAR_MISSES


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


PARA = "chr(13)||chr(10)||chr(13)||chr(10)"

PARAS = f"""
paras AS (
  SELECT doc_id, p.paragraph, p.para_idx FROM documents,
  LATERAL (SELECT unnest(string_split(text, {PARA})) AS paragraph,
                  generate_subscripts(string_split(text, {PARA}), 1) - 1 AS para_idx) p)"""

RAW_SENTS = PARAS + """,
raw_sents AS (
  SELECT doc_id, para_idx, s.sentence, s.sent_idx FROM paras,
  LATERAL (SELECT unnest(string_split(paragraph, '. ')) AS sentence,
                  generate_subscripts(string_split(paragraph, '. '), 1) - 1 AS sent_idx) s)"""

SENTENCES = RAW_SENTS + f""",
sents AS (
  SELECT doc_id, para_idx, sent_idx,
         array_to_string(regexp_extract_all(lower(sentence), {lit('[0-9A-Za-z_]+')}), ' ') AS sentence
  FROM raw_sents),
words AS (SELECT doc_id, para_idx, sent_idx, string_split_regex(sentence, {lit('[^0-9a-z]')}) AS w FROM sents),
grams AS (
  SELECT n, array_to_string(w[i:i + n - 1], ' ') AS ngram
  FROM words, (SELECT unnest([{', '.join(str(n) for n in Q.NGRAM_NS)}]) AS n) ns,
  LATERAL (SELECT unnest(generate_series(1, len(w) - n + 1)) AS i) ii),
counts AS (SELECT n, ngram, count(*) AS cnt FROM grams GROUP BY n, ngram)
"""

_ENTITIES = ", ".join(f"{lit('&' + name + ';')}: {lit(chr(c))}" for name, c in name2codepoint.items() if name != "amp")

# The token classes in their order (white space as Python's Unicode mode has it).
_BLANK = r"\t-\r\x1C-\x1F\x{85}\p{Z}"
URL = r"[hH][tT][tT][pP][sS]?://[!$-_a-z]"
TOKEN = "|".join(f"(?:{c})" for c in (
    rf"(?:\+?[01][-.{_BLANK}]*)?(?:\(?\p{{Nd}}{{3}}[-.){_BLANK}]*)?\p{{Nd}}{{3}}[-.{_BLANK}]*\p{{Nd}}{{4}}",
    URL + "+",
    r"[<>]?[:;=8][-oO*']?[)\](\[dDpP/:}{@|\\]|[)\](\[dDpP/:}{@|\\][-oO*']?[:;=8][<>]?",
    r"<[^>]+>",
    r"@[\p{L}\p{N}_]+",
    r"#+[\p{L}\p{N}_][\p{L}\p{N}_'\-]*[\p{L}\p{N}_]",
    r"[A-Za-z][A-Za-z'\-_]+[A-Za-z]",
    r"[-+]?\p{Nd}+[,/.:\-]\p{Nd}+[-+]?",
    r"[\p{L}\p{N}_]+",
    rf"\.[{_BLANK}.]*\.",
    rf"[^{_BLANK}]"))

POSTS = f"""
posts AS (
  SELECT * FROM (
    SELECT 'p' || page_id AS post_id, regexp_extract(url, {lit(HOST_REGEX)}, 1) AS user_id, html AS text FROM pages
    UNION ALL
    SELECT 'c' || conv_id || '-' || turn, 'conv' || conv_id, text FROM conversations)
  WHERE text IS NOT NULL AND user_id IS NOT NULL),
grp AS (
  SELECT user_id, CAST(('0x' || substr(md5(user_id), 1, 8))::BIGINT % {GROUP_BUCKETS} AS INTEGER) AS group_id
  FROM (SELECT DISTINCT user_id FROM posts)
  WHERE ('0x' || substr(md5(user_id), 1, 8))::BIGINT % {GROUP_BUCKETS} < {GROUPS_KEPT}),
posts_g AS (SELECT p.*, coalesce(g.group_id, 7) AS group_id FROM posts p LEFT JOIN grp g USING (user_id)),
unesc1 AS (
  SELECT *, CASE WHEN strpos(text, '&#') > 0 THEN array_to_string(list_transform(
      regexp_extract_all(text, {lit('&#[0-9]+;|&|[^&]+')}),
      lambda x: CASE WHEN regexp_full_match(x, '&#0*[0-9]{{1,8}};')
                 AND TRY_CAST(substr(x, 3, length(x) - 3) AS BIGINT) <= 1114111
                 AND TRY_CAST(substr(x, 3, length(x) - 3) AS BIGINT) NOT BETWEEN 55296 AND 57343
                THEN chr(CAST(substr(x, 3, length(x) - 3) AS INTEGER)) ELSE x END), '')
    ELSE text END AS s1
  FROM posts_g),
unesc AS (
  SELECT * EXCLUDE (s1), CASE WHEN strpos(s1, '&') = 0 THEN s1 ELSE (
      CASE WHEN len(list_filter(regexp_extract_all(s1, {lit('&[A-Za-z0-9_]+;')}), lambda e: e <> '&amp;')) > 0
           THEN replace(s2, '&amp;', ' and ') ELSE s2 END) END AS unescaped
  FROM (SELECT *, array_to_string(list_transform(
          regexp_extract_all(s1, {lit('&[A-Za-z0-9_]+;|&|[^&]+')}),
          lambda x: coalesce(map_extract_value(MAP {{{_ENTITIES}}}, x), x)), '') AS s2 FROM unesc1)),
toks AS (
  SELECT post_id, user_id, group_id, list_transform(regexp_extract_all(unescaped, {lit(TOKEN)}),
         lambda t: CASE WHEN regexp_matches(t, {lit(URL)}) THEN t ELSE lower(t) END) AS tokens
  FROM unesc),
tok_rows AS (SELECT post_id, user_id, group_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) - 1 AS pos FROM toks),
utok AS (SELECT DISTINCT user_id, group_id, token FROM tok_rows),
tusers AS (SELECT token, count(*) AS n_users FROM utok GROUP BY token),
kept AS (SELECT * FROM tusers WHERE n_users >= {Q.STANDIN_MIN_USERS}),
gtu AS (SELECT u.group_id, u.token, k.n_users AS c_all, count(*) AS c_k
        FROM utok u JOIN kept k USING (token) GROUP BY u.group_id, u.token, k.n_users)
"""

LINES_COUNT = ("(SELECT count(*) FROM pages) + (SELECT count(*) FROM conversations) + (SELECT count(*) FROM events) + "
               f"{1 + len(NEAR_MISSES)} * (SELECT count(*) FROM benchmark)")


def _w(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body


ORACLE = {
    "scan_paragraphs": _w(PARAS,
                          "SELECT doc_id, para_idx, paragraph FROM paras"),
    "split_sentences": _w(RAW_SENTS,
                          "SELECT doc_id, para_idx, sent_idx, sentence FROM raw_sents"),
    "normalize_sentence": _w(SENTENCES, "SELECT doc_id, para_idx, sent_idx, sentence FROM sents"),
    "ngrams": _w(SENTENCES, """SELECT doc_id, para_idx, sent_idx, i - 1 AS pos, array_to_string(w[i:i + 2], ' ') AS ngram
FROM words, LATERAL (SELECT unnest(generate_series(1, len(w) - 2)) AS i) ii"""),
    "ngram_counts": _w(SENTENCES, "SELECT n, ngram, cnt FROM counts"),
    "top_ngrams": _w(SENTENCES, f"""SELECT n, rnk, ngram, cnt FROM (
  SELECT n, ngram, cnt, row_number() OVER (PARTITION BY n ORDER BY cnt DESC, ngram ASC) AS rnk FROM counts)
WHERE rnk <= {Q.TOP_NGRAMS}"""),
    "row_count": f"SELECT {LINES_COUNT} AS n_rows",
    "scan_json_records": _w(POSTS, "SELECT post_id, user_id, text FROM posts"),
    "is_post": _w(POSTS, f"SELECT {LINES_COUNT} AS n_lines, count(*) AS n_posts, {LINES_COUNT} - count(*) AS n_dropped FROM posts"),
    "project_field": _w(POSTS, "SELECT user_id, text FROM posts"),
    "scan_user_groups": _w(POSTS, "SELECT user_id, group_id FROM grp"),
    "distinct_users": _w(POSTS, "SELECT count(DISTINCT user_id) AS n_users FROM posts"),
    "distinct_users_sketch": _w(POSTS, """SELECT group_id, count(DISTINCT user_id) AS n_users, true AS within FROM posts_g GROUP BY group_id
UNION ALL SELECT -1, count(DISTINCT user_id), true FROM posts"""),
    "user_to_group": _w(POSTS, "SELECT post_id, user_id, group_id FROM posts_g"),
    "posts_per_group": _w(POSTS, "SELECT group_id, count(*) AS n_posts FROM posts_g GROUP BY group_id ORDER BY group_id"),
    "unescape_entities": _w(POSTS, "SELECT post_id, unescaped FROM unesc WHERE strpos(text, '&') > 0"),
    "tokenize_posts": _w(POSTS, "SELECT post_id, pos, token FROM tok_rows"),
    "user_tokens": _w(POSTS, "SELECT user_id, token FROM utok"),
    "distinct_tokens": _w(POSTS, "SELECT count(DISTINCT token) AS n_tokens FROM utok"),
    "token_users": _w(POSTS, "SELECT token, n_users FROM tusers"),
    "min_support": _w(POSTS, "SELECT token, n_users FROM kept"),
    "top_tokens": _w(POSTS, f"SELECT token, n_users FROM kept ORDER BY n_users DESC, token ASC LIMIT {Q.TOP_TOKENS}"),
    "group_token_users": _w(POSTS, "SELECT group_id, token, c_k, c_all FROM gtu"),
    "token_totals": _w(POSTS, "SELECT group_id, token, c_k, c_all FROM gtu"),
    "semi_kept_tokens": _w(POSTS, "SELECT user_id, group_id, token FROM utok WHERE token IN (SELECT token FROM kept)"),
    "in_kept_tokens": _w(POSTS, "SELECT user_id, group_id, token FROM utok WHERE token IN (SELECT token FROM kept)"),
    "rel_popularity": _w(POSTS, f"SELECT group_id, token, round(log2(c_k / c_all), {Q.REL_DECIMALS}) AS rel_pop FROM gtu"),
    "top_tokens_per_group": _w(POSTS, f"""SELECT group_id, rnk, token, c_k, c_all, round(log2(c_k / c_all), {Q.REL_DECIMALS}) AS rel_pop FROM (
  SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY c_k / c_all DESC, token ASC) AS rnk FROM gtu)
WHERE rnk <= {Q.TOP_PER_GROUP}"""),
}
ORACLE["by_group"] = ORACLE["top_tokens_per_group"]
ORACLE["groups_sorted"] = ORACLE["posts_per_group"]
