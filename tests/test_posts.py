"""Post parsing, group lookup and relative popularity on a literal fixture."""

import math

from quarry.operators import posts as P
from quarry.sources.json import scan_json_records

LINES = [
    '{"text": "Go team go", "user": {"id_str": "u1"}}',
    '{"text": "team spirit", "user": {"id_str": "u1"}}',
    '{"text": "go home", "user": {"id_str": "u2"}}',
    '{"text": "Team work", "user": {"id_str": "u3"}}',
    '{"limit": {"track": 5}}',             # limit notice
    '{"text": null, "user": {"id_str": "u4"}}',
    '[1, 2]',                               # array
    '42',                                   # bare number
    'not json at all {',
]


def test_parse_keeps_posts_only(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    posts = scan_json_records(lines)
    assert posts.count() == 4
    assert sorted(r.user_id for r in posts.collect()) == ["u1", "u1", "u2", "u3"]


def test_group_default_and_popularity(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    groups = spark.createDataFrame([("u1", 0), ("u2", 1)], "user_id string, group_id int")
    pg = P.user_to_group(scan_json_records(lines), groups)
    per_group = {r.group_id: r.n_posts for r in P.posts_per_group(pg).collect()}
    assert per_group == {0: 2, 1: 1, 7: 1}
    utok = P.user_tokens(pg)
    tu = {r.token: r.n_users for r in P.token_users(utok).collect()}
    assert tu["go"] == 2 and tu["team"] == 2 and tu["spirit"] == 1   # users, not posts
    top = P.top_tokens_per_group(P.group_token_users(utok, 2), 10).collect()
    got = {(r.group_id, r.token): r.rel_pop for r in top}
    assert math.isclose(got[(0, "go")], math.log2(1 / 2))
    assert (1, "team") not in got            # absent, not -inf


def test_posts_job_from_manifest_files(spark):
    """Manifest -> line files -> posts -> groups -> top tokens, as the reference runs it."""
    import os
    import tempfile

    from quarry.sources.text import scan_manifest_lines

    d = tempfile.mkdtemp(prefix="quarry-posts-")
    paths = []
    for i, chunk in enumerate((LINES[:5], LINES[5:])):
        fp = os.path.join(d, f"tweets-{i}.txt")
        with open(fp, "w") as f:
            f.write("\n".join(chunk) + "\n")
        paths.append(fp)
    man = os.path.join(d, "files.txt")
    with open(man, "w") as f:
        f.write("\n".join(p + "  " for p in paths) + "\n")
    lines = scan_manifest_lines(spark, man)
    assert lines.count() == len(LINES)
    groups = spark.createDataFrame([("u1", 0), ("u2", 1)], "user_id string, group_id int")
    pg = P.user_to_group(scan_json_records(lines), groups)
    top = P.top_tokens_per_group(P.group_token_users(P.user_tokens(pg), 2), 10).collect()
    assert {(r.group_id, r.token) for r in top} == {(0, "go"), (0, "team"), (1, "go"), (7, "team")}


def test_equal_popularity_ties_are_alphabetical(spark):
    gtu = spark.createDataFrame([(0, "zeta", 1, 2), (0, "alpha", 1, 2), (0, "mid", 2, 2)],
                                "group_id int, token string, c_k bigint, c_all bigint")
    top = P.top_tokens_per_group(gtu, 10).orderBy("rnk").collect()
    assert [r.token for r in top] == ["mid", "alpha", "zeta"]


def test_user_sketches_merge_and_stay_within_their_error(spark):
    from quarry.operators import posts as P
    rows = spark.range(60_000).selectExpr("CAST(id % 3 AS INT) AS group_id", "concat('u', id % 20000) AS user_id")
    sketches = P.user_sketches(rows).persist()
    each = {r.group_id: r.n_users for r in P.estimated_users(sketches, "group_id").collect()}
    total = P.estimated_users(sketches).first().n_users
    assert len(each) == 3 and all(abs(n - 20000) <= 0.05 * 20000 for n in each.values())    # 3 and 20,000 share no factor
    assert abs(total - 20000) <= 0.05 * 20000
    merged = P.estimated_users(sketches.unionByName(sketches)).first().n_users
    assert merged == total          # merging a sketch twice changes nothing
    few = P.user_sketches(spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None)], "group_id int, user_id string"))
    assert P.estimated_users(few).first().n_users == 2
    exact = P.distinct_users(rows).first().n_users
    assert exact == 20000


def test_totals_by_join_equal_the_window(spark):
    from quarry.operators import posts as P
    utok = spark.createDataFrame([(f"u{i}", i % 3, t) for i in range(30) for t in ("a", "b", "c")[:1 + i % 3]], "user_id string, group_id int, token string")
    kept = P.min_support(P.token_users(utok), 11)
    assert sorted(P.token_totals(utok, kept).collect()) == sorted(P.group_token_users(utok, 11).collect())
