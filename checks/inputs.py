"""The given tables seen as interactions, catalog, comments and a sparse set.

Each view comes twice: as a DataFrame and as the SQL of the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsense.functions.events import completion
from clipsense.functions.items import engagement_ratio
from clipsense.functions.rules import lookup
from clipsense.functions.weights import event_weight

EVENT_NAMES = {"view": "view", "click": "like", "signup": "comment", "purchase": "share"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    watch = F.when(F.col("event_type") == "view", F.col("value"))
    minute = F.when(F.col("event_type") == "view", F.lit(60.0))
    rows = table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("video_id"),
        lookup(F.col("event_type"), EVENT_NAMES, "skip").alias("event_type"),
        F.col("ts").alias("event_time"),
        watch.alias("watch_time"),
        minute.alias("total_duration"),
        completion(watch, minute).alias("completion_rate"),
    )
    return rows.withColumn("weight", event_weight(F.col("event_type"), F.col("completion_rate")))


IX = """ix0 AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS user_id,
         regexp_extract(props, '"k":\\s*(-?\\d+)', 1) AS video_id,
         CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'like' WHEN 'signup' THEN 'comment'
              WHEN 'purchase' THEN 'share' ELSE 'skip' END AS event_type,
         ts AS event_time,
         CASE WHEN event_type = 'view' THEN value END AS watch_time,
         CASE WHEN event_type = 'view' THEN 60.0::DOUBLE END AS total_duration,
         CASE WHEN event_type = 'view' AND value IS NOT NULL THEN least(1.0::DOUBLE, value / 60.0::DOUBLE) END AS completion_rate
  FROM events),
ix AS (
  SELECT *, CASE
      WHEN event_type = 'view' THEN CASE WHEN completion_rate > 0.8::DOUBLE THEN 5.0::DOUBLE
           WHEN completion_rate > 0.5::DOUBLE THEN 3.0::DOUBLE WHEN completion_rate > 0.3::DOUBLE THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END
      WHEN event_type = 'like' THEN 10.0::DOUBLE WHEN event_type = 'share' THEN 15.0::DOUBLE
      WHEN event_type = 'comment' THEN 8.0::DOUBLE WHEN event_type = 'skip' THEN -2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM ix0)"""


def as_of(spark: SparkSession, sf: str) -> Column:
    """The time of the last event, as a literal that reaches the scan."""
    last = table(spark, sf, "events").agg(F.max("ts").cast("string").alias("t")).first()["t"]
    return F.lit(last).cast("timestamp_ntz")


AS_OF = "(SELECT max(ts) FROM events)"


def visits(spark: SparkSession, sf: str) -> DataFrame:
    """All events with one user per user and day.

    Over a whole month every user reaches the score cap; by day all user
    types occur, and days without a view as well.
    """
    day = F.date_format("event_time", "yyyyMMdd")
    return interactions(spark, sf).withColumn("user_id", F.concat_ws("-", "user_id", day))


VISITS = f"{IX}, vis AS (SELECT ix.* REPLACE (user_id || '-' || strftime(event_time, '%Y%m%d') AS user_id) FROM ix)"


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("video_id"),
        F.col("p_name").alias("title"),
        F.replace("p_name", F.lit(" "), F.lit(",")).alias("tags"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("creator_id"),
        F.col("p_size").cast("double").alias("duration"),
    )


CAT = """cat AS (
  SELECT CAST(p_partkey AS VARCHAR) AS video_id, p_name AS title, replace(p_name, ' ', ',') AS tags,
         p_type AS category, p_brand AS creator_id, CAST(p_size AS DOUBLE) AS duration FROM part)"""


def likes_views(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("video_id")).agg(
        F.count("*").alias("likes"), F.sum("l_quantity").cast("bigint").alias("views")
    )


LV = """lv AS (
  SELECT CAST(l_partkey AS VARCHAR) AS video_id, count(*) AS likes, CAST(sum(l_quantity) AS BIGINT) AS views
  FROM lineitem GROUP BY 1)"""


def counted_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog with likes, views and their ratio."""
    return catalog(spark, sf).join(likes_views(spark, sf), "video_id", "left").withColumn(
        "engagement_score", engagement_ratio(F.col("likes"), F.col("views"))
    )


CCAT = f"""{CAT}, {LV}, ccat AS (
  SELECT cat.*, likes, views, CAST(likes AS DOUBLE) / (views + 1) * 100 AS engagement_score
  FROM cat LEFT JOIN lv USING (video_id))"""


def comments(spark: SparkSession, sf: str) -> DataFrame:
    """All turns as comments of the speakers; tabs and line breaks become blanks, as in a TSV."""
    return table(spark, sf, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), "role").alias("user_id"),
        F.col("turn").cast("string").alias("video_id"),
        F.regexp_replace("text", "[\\t\\r\\n]+", " ").alias("comment_content"),
    )


COM = """com AS (
  SELECT concat_ws('-', CAST(conv_id AS VARCHAR), role) AS user_id, CAST(turn AS VARCHAR) AS video_id,
         regexp_replace(text, '[\\t\\r\\n]+', ' ', 'g') AS comment_content
  FROM conversations)"""


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """user, item, milliseconds: the raw rows of the pair file."""
    return interactions(spark, sf).select(
        "user_id", "video_id", F.unix_millis(F.col("event_time").cast("timestamp")).alias("timestamp")
    )


PAIRS = f"{IX}, pairs AS (SELECT user_id, video_id, epoch_us(event_time) // 1000 AS timestamp FROM ix)"


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    """The sparse user-item set: customers and the parts they ordered."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("video_id"),
        F.col("l_quantity").alias("weight"),
        F.col("l_shipdate").alias("event_time"),
    )


BUY = """buy AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS video_id,
         l_quantity AS weight, l_shipdate AS event_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def r(expression: str, name: str) -> str:
    """A double rounded as ``present`` rounds it."""
    return f"round(CAST({expression} AS DOUBLE), 9) AS {name}"


def t(expression: str, name: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


def draw(salt: str, *keys: str) -> str:
    parts = ", ".join(keys)
    return f"(CAST('0x' || substr(md5(concat_ws('|', '{salt}', {parts})), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"
