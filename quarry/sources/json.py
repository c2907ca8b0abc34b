"""JSON-lines posts with a declared, pruned schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Only the fields the jobs read; from_json skips everything else while parsing.
POST_SCHEMA = T.StructType([
    T.StructField("id_str", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("user", T.StructType([T.StructField("id_str", T.StringType())])),
])


def parse_json_records(lines: DataFrame, value_col: str = "value",
                       schema: T.StructType = POST_SCHEMA) -> DataFrame:
    """One ``p`` struct a line; NULL unless the whole line is a single JSON object.

    ``from_json`` ignores what follows a value. So a line is parsed inside an
    array, where text behind the object shows as a second element or an
    error unless it closes the array, and inside an object, where it is an
    error unless it closes that object. Only a single whole object passes
    both. A generator binds the two results, so each is evaluated once a line
    however often ``p`` is used.
    """
    strict = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
    line = F.col(value_col)
    as_array = F.from_json(F.concat(F.lit("["), line, F.lit("]")), T.ArrayType(schema), strict)
    as_member = F.from_json(F.concat(F.lit('{"v":'), line, F.lit("}")),
                            T.StructType([T.StructField("v", T.StructType([schema.fields[0]]))]), strict)
    both = lines.select(F.explode(F.array(F.struct(as_array.alias("a"), as_member.alias("m")))).alias("both"))
    whole = (F.size("both.a") == 1) & F.col("both.m.v").isNotNull()
    return both.select(F.when(whole, F.col("both.a")[0]).alias("p"))


def is_post(parsed: Column) -> Column:
    """A record is a post when it parsed and has a text and a user."""
    return parsed["text"].isNotNull() & parsed["user"].isNotNull() & parsed["user"]["id_str"].isNotNull()


def scan_json_records(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Posts ``(post_id, user_id, text)`` of JSON lines; everything else dropped."""
    p = parse_json_records(lines, value_col)
    return (p.where(is_post(F.col("p")))
             .select(F.col("p.id_str").alias("post_id"),
                     F.col("p.user.id_str").alias("user_id"),
                     F.col("p.text").alias("text")))

