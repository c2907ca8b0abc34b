"""The streaming posts count equals the batch count on the same lines."""

import os
import tempfile
import uuid

from quarry.streaming.posts import posts_per_group_stream, start_to_memory

LINES = [
    '{"text": "a b", "user": {"id_str": "u1"}}',
    '{"text": "c", "user": {"id_str": "u2"}}',
    '{"text": "d", "user": {"id_str": "u9"}}',
    '{"limit": {"track": 1}}',
    'broken {',
]


def test_stream_counts(spark):
    d = tempfile.mkdtemp(prefix="quarry-stream-test-")
    for i in range(2):
        with open(os.path.join(d, f"part-{i}.txt"), "w") as f:
            f.write("\n".join(LINES) + "\n")
    groups = spark.createDataFrame([("u1", 0), ("u2", 3)], "user_id string, group_id int")
    # a stream resumes from its checkpoint, so each test run uses a new name
    name = f"posts_stream_test_{uuid.uuid4().hex}"
    q = start_to_memory(spark, posts_per_group_stream(spark, d, groups), name)
    try:
        q.processAllAvailable()
        got = {r.group_id: r.n_posts for r in spark.sql(f"SELECT * FROM {name}").collect()}
        assert got == {0: 2, 3: 2, 7: 2}
        # a file arriving later updates the running counts
        with open(os.path.join(d, "part-9.txt"), "w") as f:
            f.write(LINES[0] + "\n" + LINES[2] + "\n")
        q.processAllAvailable()
        got = {r.group_id: r.n_posts for r in spark.sql(f"SELECT * FROM {name}").collect()}
        assert got == {0: 3, 3: 2, 7: 3}
    finally:
        q.stop()
