"""Small, time-limited snapshots for serving, and the event bus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsense import fixed_values as V
from clipsense.functions.events import topic


def _expires(as_of: Column, ttl: int) -> Column:
    return as_of + F.make_dt_interval(secs=F.lit(ttl).cast("decimal(18,6)"))


def hot_profiles(profiles: DataFrame, as_of: Column, n: int = 1000) -> DataFrame:
    """Key, JSON value and expiry of the n highest-scored users."""
    return (
        profiles.select("user_id", *V.HOT_PROFILE_FIELDS)
        .orderBy(F.col("user_score").desc(), "user_id")
        .limit(n)
        .select(
            F.concat(F.lit("profile:"), "user_id").alias("key"),
            F.to_json(F.struct(*V.HOT_PROFILE_FIELDS)).alias("value"),
            _expires(as_of, V.PROFILE_TTL).alias("expires_at"),
        )
    )


def trending_snapshot(ranked: DataFrame, as_of: Column) -> DataFrame:
    """Rows of the trending list, valid for an hour."""
    return ranked.select("rank", "video_id", "score").withColumn("expires_at", _expires(as_of, V.TRENDING_TTL))


def bus_messages(events: DataFrame) -> DataFrame:
    """Topic, key and JSON value, as the Kafka writer expects them."""
    return events.select(
        topic(F.col("event_type")).alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct(*events.columns)).alias("value"),
    )


def send_to_kafka(events: DataFrame, servers: str) -> None:
    bus_messages(events).write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def send_to_files(events: DataFrame, path: str, files: int | None = None) -> None:
    """The same messages as JSON lines, one folder per topic."""
    messages = bus_messages(events).select("topic", "value")
    if files:
        messages = messages.repartition(files)
    messages.write.partitionBy("topic").mode("append").text(path)
