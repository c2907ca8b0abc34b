"""Stand-in inputs built from the driver's test tables.

Each builder only reshapes test tables into the schema a job expects (JSON
lines, a user -> group mapping, day-slot series, numeric feature tables).
None of them does any of the job's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_bucket
from quarry.sources.tables import read_table

# URL host: text between "scheme://" and the first / ? # or :
HOST_REGEX = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]+)"
GROUP_BUCKETS = 9    # users hashed to 0..8; 0..6 are groups, 7 and 8 stay unmapped
GROUPS_KEPT = 7


def post_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(post_id, user_id, text)``: web pages (user = site host) and conversation turns."""
    pages = read_table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("post_id"),
        F.regexp_extract("url", HOST_REGEX, 1).alias("user_id"),
        F.col("html").alias("text"))
    turns = read_table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("post_id"),
        F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("user_id"),
        F.col("text"))
    return pages.unionByName(turns)


#: What makes a line with a post on it no record: text behind the object, another object, a wrapping, an early end.
NEAR_MISSES = ("{0} garbage", "{0}{0}", "{0},{0}", "{0}]", "{0}] x", "{0}}} x", '{0},"w":{{"v":1', "[{0}]", '"w":{0}', "{0}}}", "'{0}'", "{0", "x {0}")


def post_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value STRING`` lines as a post stream delivers them.

    Posts become JSON objects with ``id_str``, ``text`` and ``user.id_str``;
    ``events.props`` lines are valid JSON that are not posts (like limit
    notices); ``benchmark.text`` lines are not JSON at all, and each
    benchmark item also comes as the lines of ``NEAR_MISSES``.
    """
    def as_json(post_id, text, user_id):
        return F.to_json(F.struct(post_id.alias("id_str"), text.alias("text"), F.struct(user_id.alias("id_str")).alias("user")))

    posts = post_records(spark, sf_dir).select(as_json(F.col("post_id"), F.col("text"), F.col("user_id")).alias("value"))
    notices = read_table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    items = read_table(spark, sf_dir, "benchmark")
    broken = items.select(F.col("text").alias("value"))
    whole = as_json(F.concat(F.lit("b"), F.col("item_id").cast("string")), F.col("text"), F.lit("nobody"))
    head = F.expr("substring(j, 1, length(j) - 1)")
    misses = [head if form == "{0" else F.concat(*_filled(form, F.col("j"))) for form in NEAR_MISSES]
    near = items.select(whole.alias("j")).select(F.explode(F.array(*misses)).alias("value"))
    return posts.unionByName(notices).unionByName(broken).unionByName(near)


def _filled(form: str, value) -> list:
    """The parts of a format string with ``value`` where it has {0}."""
    parts = [F.lit(p.replace("{{", "{").replace("}}", "}")) for p in form.split("{0}")]
    return [x for p in parts[:-1] for x in (p, value)] + parts[-1:]


def user_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, group_id)`` for the users whose hash bucket is below 7."""
    users = post_records(spark, sf_dir).select("user_id").distinct()
    return (users.select("user_id", hash_bucket(F.col("user_id"), GROUP_BUCKETS).alias("group_id"))
            .where(F.col("group_id") < GROUPS_KEPT))


EVENT_SLOTS = 8      # of three hours


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean event value per (user, event type, year, three hours of the day): one series cell."""
    ev = read_table(spark, sf_dir, "events")
    return (ev.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("station"),
                      F.col("event_type").alias("measurement"), F.year("ts").alias("year"),
                      F.floor(F.hour("ts") / 3).cast("int").alias("slot"), "value")
            .groupBy("station", "measurement", "year", "slot").agg(F.avg("value").alias("v")))


def event_series_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested station records: ``station, years ARRAY<STRUCT<measurement, year, values>>``.

    A user stands for a station, an event type for a measurement and parts of
    the day for the slots. Slots without events are NULL. A record ends with
    its last slot that has events, so about a fifth of them are too short.
    """
    cells = event_cells(spark, sf_dir)
    per_series = (cells.groupBy("station", "measurement", "year")
                  .agg(F.map_from_entries(F.collect_list(F.struct("slot", "v"))).alias("m"), F.max("slot").alias("last")))
    values = F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.try_element_at("m", i))
    flat = per_series.select("station", "measurement", "year", values.alias("values"))
    return flat.groupBy("station").agg(
        F.collect_list(F.struct("measurement", "year", "values")).alias("years"))


# Stand-in for the particle table: label first, numeric features after it.
PARTICLE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber",
                     "ship_doy", "ship_year"]
# Stand-in for the regression table: four inputs and three targets.
REGRESSION_INPUTS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
REGRESSION_TARGETS = ["l_extendedprice", "disc_price", "charge"]


def line_key() -> "F.Column":
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


def particle_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key, label, features...)`` from lineitem; label 1.0 for returned lines."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(line_key().alias("key"),
                     (F.col("l_returnflag") == "R").cast("double").alias("label"),
                     "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     F.col("l_linenumber").cast("double").alias("l_linenumber"),
                     F.dayofyear("l_shipdate").cast("double").alias("ship_doy"),
                     F.year("l_shipdate").cast("double").alias("ship_year"))


def regression_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key, inputs..., targets...)`` from lineitem."""
    li = read_table(spark, sf_dir, "lineitem")
    disc = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.select(line_key().alias("key"), "l_quantity", "l_discount", "l_tax",
                     F.col("l_linenumber").cast("double").alias("l_linenumber"), "l_extendedprice",
                     disc.alias("disc_price"), (disc * (1 + F.col("l_tax"))).alias("charge"))


def cover_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, label, embedding)``: class code and 64 numeric features."""
    return read_table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))


# Stand-in for the wide class table, in its layout: 10 continuous columns, then 44 binary ones.
COVER_CONTINUOUS, COVER_BINARY = 10, 44
COVER_NAMES = [f"c{i}" for i in range(COVER_CONTINUOUS)] + [f"b{i}" for i in range(COVER_BINARY)]
COVER_NOMINAL = {COVER_CONTINUOUS + i: 2 for i in range(COVER_BINARY)}


def cover_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, label, features ARRAY)``: components as they are, then the signs of others as indicators."""
    e = F.col("embedding")
    signs = F.transform(F.slice(e, COVER_CONTINUOUS + 1, COVER_BINARY), lambda x: (x > 0).cast("double"))
    return cover_table(spark, sf_dir).select("vec_id", "label", F.concat(F.slice(e, 1, COVER_CONTINUOUS), signs).alias("features"))
