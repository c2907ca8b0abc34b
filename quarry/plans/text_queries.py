"""Registered queries for the text jobs: n-grams and post tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import ngrams as NG
from quarry.operators import posts as P
from quarry.sources.json import parse_json_records, scan_json_records, is_post
from quarry.sources.standins import post_json_lines, user_groups
from quarry.sources.tables import read_table, spread

NGRAM_NS = (1, 2, 3, 4, 5)
TOP_NGRAMS = 5
# The stand-in has about 5 % as many users as the reference sample relative to
# its threshold of 100, so the threshold here is 10 users.
STANDIN_MIN_USERS = 10
TOP_TOKENS = 20
TOP_PER_GROUP = 10
REL_DECIMALS = 10


# ---- n-grams over documents.text -------------------------------------------

def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return NG.corpus_sentences(spread(docs))


def q_scan_paragraphs(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(T.paragraphs(F.col("text"))).alias("para_idx", "paragraph"))


def q_split_sentences(spark, sf_dir):
    paras = q_scan_paragraphs(spark, sf_dir)
    return NG.split_sentences(paras).select("doc_id", "para_idx", "sent_idx", "sentence")


def q_normalize_sentence(spark, sf_dir):
    return _sentences(spark, sf_dir).select("doc_id", "para_idx", "sent_idx", "sentence")


def q_ngrams(spark, sf_dir):
    """Every 3-gram occurrence with its sentence (the ``ngrams`` expression)."""
    s = _sentences(spark, sf_dir)
    return s.select("doc_id", "para_idx", "sent_idx",
                    F.posexplode(T.ngrams(T.ngram_words(F.col("sentence")), 3)).alias("pos", "ngram"))


def q_ngram_counts(spark, sf_dir):
    return NG.ngram_counts(_sentences(spark, sf_dir), NGRAM_NS)


def q_top_ngrams(spark, sf_dir):
    return NG.top_ngrams(NG.ngram_counts(_sentences(spark, sf_dir), NGRAM_NS), TOP_NGRAMS)


# ---- posts -------------------------------------------------------------------

def _posts(spark, sf_dir):
    return scan_json_records(spread(post_json_lines(spark, sf_dir)))


def _posts_grouped(spark, sf_dir):
    return P.user_to_group(_posts(spark, sf_dir), user_groups(spark, sf_dir))


def _utok(spark, sf_dir):
    return P.user_tokens(_posts_grouped(spark, sf_dir))


def _utok_all(spark, sf_dir):
    """Users' tokens for jobs that do not ask for the group: no join."""
    return P.user_tokens(_posts(spark, sf_dir))


def _kept(utok):
    return P.min_support(P.token_users(utok), STANDIN_MIN_USERS)


def q_row_count(spark, sf_dir):
    return post_json_lines(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


def q_scan_json_records(spark, sf_dir):
    return _posts(spark, sf_dir)


def q_is_post(spark, sf_dir):
    p = parse_json_records(post_json_lines(spark, sf_dir))
    flag = is_post(F.col("p"))
    return p.agg(F.count(F.lit(1)).alias("n_lines"),
                 F.sum(flag.cast("int")).alias("n_posts"),
                 F.sum((~flag | flag.isNull()).cast("int")).alias("n_dropped"))


def q_project_field(spark, sf_dir):
    return _posts(spark, sf_dir).select("user_id", "text")


def q_scan_user_groups(spark, sf_dir):
    return user_groups(spark, sf_dir)


def q_distinct_users(spark, sf_dir):
    return P.distinct_users(_posts(spark, sf_dir))


SKETCH_BOUND = 0.05      # four standard errors


def q_distinct_users_sketch(spark, sf_dir):
    """Users per group and overall (group -1), and whether the sketches' estimates are within the bound of them."""
    posts = _posts_grouped(spark, sf_dir)
    sketches = P.user_sketches(posts)
    exact = (posts.groupBy("group_id").agg(F.countDistinct("user_id").alias("n_users"))
             .unionByName(P.distinct_users(posts).withColumn("group_id", F.lit(-1))))
    guess = (P.estimated_users(sketches, "group_id")
             .unionByName(P.estimated_users(sketches).withColumn("group_id", F.lit(-1))).withColumnRenamed("n_users", "guess"))
    return exact.join(guess, "group_id").select(
        "group_id", "n_users", (F.abs(F.col("guess") - F.col("n_users")) <= SKETCH_BOUND * F.col("n_users")).alias("within"))


def q_user_to_group(spark, sf_dir):
    return _posts_grouped(spark, sf_dir).select("post_id", "user_id", "group_id")


def q_posts_per_group(spark, sf_dir):
    return P.posts_per_group(_posts_grouped(spark, sf_dir))


def q_unescape_entities(spark, sf_dir):
    posts = _posts(spark, sf_dir).where(F.instr("text", "&") > 0)
    return posts.select("post_id", T.unescape_entities(F.col("text")).alias("unescaped"))


def q_tokenize_posts(spark, sf_dir):
    return P.tokenize_posts(_posts(spark, sf_dir)).select("post_id", "pos", "token")


def q_user_tokens(spark, sf_dir):
    return _utok_all(spark, sf_dir).select("user_id", "token")


def q_distinct_tokens(spark, sf_dir):
    return P.distinct_tokens(_utok_all(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n_tokens"))


def q_token_users(spark, sf_dir):
    return P.token_users(_utok_all(spark, sf_dir))


def q_min_support(spark, sf_dir):
    return _kept(_utok_all(spark, sf_dir))


def q_top_tokens(spark, sf_dir):
    return P.top_tokens(_kept(_utok_all(spark, sf_dir)), TOP_TOKENS)


def q_token_totals(spark, sf_dir):
    utok = _utok(spark, sf_dir)
    return P.token_totals(utok, _kept(utok))


def q_group_token_users(spark, sf_dir):
    return P.group_token_users(_utok(spark, sf_dir), STANDIN_MIN_USERS)


def q_semi_kept_tokens(spark, sf_dir):
    utok = _utok(spark, sf_dir)
    return P.semi_kept_tokens(utok, _kept(utok)).select("user_id", "group_id", "token")


def q_rel_popularity(spark, sf_dir):
    g = q_group_token_users(spark, sf_dir)
    return g.select("group_id", "token",
                    F.round(P.rel_popularity(F.col("c_k"), F.col("c_all")), REL_DECIMALS).alias("rel_pop"))


def q_top_tokens_per_group(spark, sf_dir):
    gtu = P.group_token_users(_utok(spark, sf_dir), STANDIN_MIN_USERS)
    return P.top_tokens_per_group(gtu, TOP_PER_GROUP, REL_DECIMALS)


QUERIES = {
    "scan_paragraphs": q_scan_paragraphs,
    "split_sentences": q_split_sentences,
    "normalize_sentence": q_normalize_sentence,
    "ngrams": q_ngrams,
    "ngram_counts": q_ngram_counts,
    "top_ngrams": q_top_ngrams,
    "row_count": q_row_count,
    "scan_json_records": q_scan_json_records,
    "is_post": q_is_post,
    "project_field": q_project_field,
    "scan_user_groups": q_scan_user_groups,
    "distinct_users": q_distinct_users,
    "distinct_users_sketch": q_distinct_users_sketch,
    "user_to_group": q_user_to_group,
    "posts_per_group": q_posts_per_group,
    "groups_sorted": q_posts_per_group,
    "unescape_entities": q_unescape_entities,
    "tokenize_posts": q_tokenize_posts,
    "user_tokens": q_user_tokens,
    "distinct_tokens": q_distinct_tokens,
    "token_users": q_token_users,
    "min_support": q_min_support,
    "top_tokens": q_top_tokens,
    "group_token_users": q_group_token_users,
    "semi_kept_tokens": q_semi_kept_tokens,
    "in_kept_tokens": q_semi_kept_tokens,
    "token_totals": q_token_totals,
    "rel_popularity": q_rel_popularity,
    "top_tokens_per_group": q_top_tokens_per_group,
    "by_group": q_top_tokens_per_group,
}
