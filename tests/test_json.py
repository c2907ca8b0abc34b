"""Only lines that are one whole JSON object are records."""

import json

from pyspark.sql import functions as F

from quarry.sources import json as J
from quarry.sources.standins import NEAR_MISSES

POST = '{"id_str":"1","text":"a } ] \\" b","user":{"id_str":"u"},"more":[1,{"v":2}]}'


def kept(spark, lines):
    rows = J.scan_json_records(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    return [(r.post_id, r.user_id, r.text) for r in rows]


def test_near_misses_are_dropped(spark):
    wrong = [form.replace("{0}", POST).replace("{{", "{").replace("}}", "}") if form != "{0" else POST[:-1] for form in NEAR_MISSES]
    for line in wrong:
        try:
            value = json.loads(line)
        except ValueError:
            value = None
        assert not isinstance(value, dict), line
    wrong += [None, "", " ", "1", '"x"', "null", "[]", "{}", "{}]", "{},{}", POST + "\x00", POST + "/", POST + " 1", POST.replace('"', "'")]
    assert kept(spark, wrong) == []
    assert kept(spark, [POST, f"  {POST}\t", POST]) == [("1", "u", 'a } ] " b')] * 3


def test_posts_need_text_and_user(spark):
    lines = ['{"text":"a"}', '{"user":{"id_str":"u"}}', '{"text":null,"user":{"id_str":"u"}}', '{"text":"a","user":5}', '{"limit":{"track":5}}']
    assert kept(spark, lines) == []


def test_a_line_is_parsed_once_each_way(spark):
    lines = spark.createDataFrame([(POST,)], "value string")
    plan = J.scan_json_records(lines).where(F.col("text").contains("a")).groupBy("user_id").agg(F.max("text"), F.max("post_id")) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 2, plan
