"""Token popularity of posts by user group.

Plan (one DAG): parse JSON -> keep posts -> tag each post with its user's
group (left join, missing users -> group 7) -> tokenize -> unique
(group, user, token) -> users per (group, token) -> users per token as a
window sum over groups -> keep tokens with enough users -> relative
popularity -> top k per group.

Shuffles are keyed by (user, token) or token, never by user alone, so one
very active user cannot pile up in one task; counts are partially
aggregated before every exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import PRESERVE_CASE_REGEX, tokenize

DEFAULT_GROUP = 7
MIN_USERS = 100


def user_to_group(posts: DataFrame, groups: DataFrame, default_group: int = DEFAULT_GROUP) -> DataFrame:
    """Left join posts to ``groups(user_id, group_id)``; unknown users get ``default_group``.

    No hint is given: a small mapping is broadcast by the planner from its
    size statistics (or by AQE at run time); a large one is sort-merge
    joined, with AQE splitting a hot user's partition.
    """
    g = groups.select("user_id", F.col("group_id").cast("int").alias("group_id"))
    return (posts.join(g, "user_id", "left")
            .withColumn("group_id", F.coalesce(F.col("group_id"), F.lit(default_group))))


def posts_per_group(posts_with_group: DataFrame) -> DataFrame:
    """``(group_id, n_posts)`` ordered by group."""
    return (posts_with_group.groupBy("group_id").agg(F.count(F.lit(1)).alias("n_posts"))
            .orderBy("group_id"))


def distinct_users(posts: DataFrame) -> DataFrame:
    return posts.agg(F.countDistinct("user_id").alias("n_users"))


def user_sketches(posts: DataFrame, by: str = "group_id", lg_k: int = 12) -> DataFrame:
    """``(by, sketch)``: a HyperLogLog sketch of each group's users.

    Sketches are binary columns of at most 2^lg_k bytes or so whatever the
    number of users. They can be stored, and sketches of other days or groups
    merged with them later, without the users. The standard error of an
    estimate is about 0.83 / 2^(lg_k / 2), 1.3 % here.
    """
    return posts.groupBy(by).agg(F.hll_sketch_agg("user_id", lg_k).alias("sketch"))


def estimated_users(sketches: DataFrame, *by: str) -> DataFrame:
    """``(by..., n_users)``: estimated distinct users of the union of the sketches, overall or by columns."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_users"))


def tokenize_posts(posts: DataFrame, preserve_case_regex: str | None = PRESERVE_CASE_REGEX) -> DataFrame:
    """One row per token occurrence: ``(..., pos, token)``."""
    keep = [c for c in posts.columns if c != "text"]
    return posts.select(*keep, F.posexplode(tokenize(F.col("text"), preserve_case_regex)).alias("pos", "token"))


def user_tokens(posts: DataFrame, preserve_case_regex: str | None = PRESERVE_CASE_REGEX) -> DataFrame:
    """Unique ``(user_id, [group_id,] token)``: the union of each user's token sets."""
    keys = ["user_id"] + (["group_id"] if "group_id" in posts.columns else [])
    toks = posts.select(*keys, F.explode(tokenize(F.col("text"), preserve_case_regex)).alias("token"))
    return toks.dropDuplicates(keys + ["token"])


def distinct_tokens(utok: DataFrame) -> DataFrame:
    return utok.select("token").distinct()


def token_users(utok: DataFrame) -> DataFrame:
    """``(token, n_users)``: number of users who used each token."""
    return utok.groupBy("token").agg(F.count(F.lit(1)).alias("n_users"))


def min_support(tu: DataFrame, min_users: int = MIN_USERS) -> DataFrame:
    return tu.where(F.col("n_users") >= min_users)


def top_tokens(kept: DataFrame, k: int = 20) -> DataFrame:
    """The k tokens with most users; ties by token ascending."""
    return kept.orderBy(F.col("n_users").desc(), F.col("token").asc()).limit(k)


def group_token_users(utok: DataFrame, min_users: int = MIN_USERS) -> DataFrame:
    """``(group_id, token, c_k, c_all)`` for tokens used by at least ``min_users`` users.

    Every user belongs to exactly one group, so a token's total number of
    users is the sum of its per-group counts: ``c_all`` is a window sum over
    the (group, token) aggregate partitioned by token (at most 8 rows per
    token). This replaces the join with the kept-token table, so the posts
    are tokenized once and no token table is broadcast or shuffled twice.
    """
    ck = utok.groupBy("group_id", "token").agg(F.count(F.lit(1)).alias("c_k"))
    c_all = F.sum("c_k").over(Window.partitionBy("token"))
    return (ck.withColumn("c_all", c_all).where(F.col("c_all") >= min_users)
            .select("group_id", "token", "c_k", "c_all"))


def token_totals(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """Each (group, token) count with the token's users in all groups, for kept tokens only.

    One inner join by token both filters and brings the total. Both sides
    are aggregates; AQE broadcasts the kept tokens if they are few.
    """
    return (counts.groupBy("group_id", "token").agg(F.count(F.lit(1)).alias("c_k"))
            .join(kept.select("token", F.col("n_users").alias("c_all")), "token")
            .select("group_id", "token", "c_k", "c_all"))


def semi_kept_tokens(utok: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``utok`` whose token is in ``kept`` (left semi join).

    Spark broadcasts ``kept`` when its size estimate is under the broadcast
    threshold, or when AQE measures it small at run time.
    """
    return utok.join(kept.select("token"), "token", "left_semi")


def rel_popularity(c_k, c_all):
    """log2(c_k / c_all)."""
    return F.log2(c_k / c_all)


def top_tokens_per_group(gtu: DataFrame, k: int = 10, decimals: int | None = None) -> DataFrame:
    """Top k tokens by relative popularity in each group; ties by token."""
    rel = rel_popularity(F.col("c_k"), F.col("c_all"))
    scored = gtu.withColumn("rel_pop", rel)
    # log2 is monotone, so ranking by the exact ratio gives the same order and
    # does not depend on how a platform rounds the logarithm.
    ratio = F.col("c_k") / F.col("c_all")
    w = Window.partitionBy("group_id").orderBy(ratio.desc(), F.col("token").asc())
    out = (scored.withColumn("rnk", F.row_number().over(w)).where(F.col("rnk") <= k)
           .select("group_id", "rnk", "token", "c_k", "c_all", "rel_pop"))
    if decimals is not None:
        out = out.withColumn("rel_pop", F.round("rel_pop", decimals))
    return out
