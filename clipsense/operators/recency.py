"""Most recent events, counters with an idle timer, sessions.

A cache key whose timer restarts on each write holds everything since the
last pause longer than the timer. Two events of one key in the same time
bucket as wide as the timer are always closer than that, so events are first
reduced to one row per key and bucket; pauses are looked for between those
few rows, and no key's history meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipsense import fixed_values as V
from clipsense.functions.rules import micros
from clipsense.operators.ranking import top_per_key


def latest_first() -> list[Column]:
    return [F.col("event_time").desc(), F.col("video_id"), F.col("event_type")]


def recent_interactions(interactions: DataFrame, n: int = 100) -> DataFrame:
    return top_per_key(interactions, "user_id", latest_first(), n)


def recent_videos(interactions: DataFrame, n: int = 100) -> DataFrame:
    """Last n (video, weight) per user, oldest first as a push list keeps them."""
    kept = recent_interactions(interactions, n)
    window = Window.partitionBy("user_id").orderBy(F.col("rank").desc())
    return kept.select(
        "user_id", F.row_number().over(window).alias("pos"), "video_id", "weight", "event_time"
    )


def interaction_counter(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("user_id").agg(
        F.count("*").alias("total_interactions"), F.max("event_time").alias("last_activity")
    )


def _buckets(events: DataFrame, keys: list[str], gap: int, *measures: Column) -> DataFrame:
    us = micros(F.col("event_time"))
    return (
        events.withColumn("_us", us)
        .groupBy(*keys, F.floor(F.col("_us") / (gap * 1_000_000)).alias("_bucket"))
        .agg(F.min("_us").alias("first_us"), F.max("_us").alias("last_us"), *measures)
    )


def _session_numbers(buckets: DataFrame, key: str, gap: int) -> DataFrame:
    """Number the sessions of each key; a pause longer than ``gap`` ends one."""
    in_order = Window.partitionBy(key).orderBy("first_us")
    pause = F.col("first_us") - F.lag("last_us").over(in_order)
    starts = F.when(pause.isNull() | (pause > gap * 1_000_000), 1).otherwise(0)
    return buckets.withColumn("_starts", starts).withColumn("session_no", F.sum("_starts").over(in_order))


def sessions(events: DataFrame, key: str = "user_id", gap: int = V.SESSION_GAP) -> DataFrame:
    """Events, watch time and duration of each session of each key."""
    buckets = _buckets(
        events, [key], gap, F.count("*").alias("events"), F.sum("watch_time").alias("watch_time")
    )
    return (
        _session_numbers(buckets, key, gap)
        .groupBy(key, "session_no")
        .agg(
            F.min("first_us").alias("first_us"),
            F.max("last_us").alias("last_us"),
            F.sum("events").alias("events"),
            F.coalesce(F.sum("watch_time"), F.lit(0.0)).alias("watch_time"),
        )
        .select(
            key,
            "session_no",
            F.timestamp_micros("first_us").alias("started_at"),
            "events",
            "watch_time",
            ((F.col("last_us") - F.col("first_us")) / 1_000_000).alias("duration_seconds"),
        )
    )


def live_since(events: DataFrame, key: str, ttl: int, as_of: Column) -> DataFrame:
    """Start of the session whose timer still runs at ``as_of``, per key."""
    past = events.filter(F.col("event_time") <= as_of)
    numbered = _session_numbers(_buckets(past, [key], ttl), key, ttl)
    return (
        numbered.groupBy(key)
        .agg(
            F.max(F.when(F.col("_starts") == 1, F.col("first_us"))).alias("live_from_us"),
            F.max("last_us").alias("last_us"),
        )
        .filter(micros(as_of) - F.col("last_us") <= ttl * 1_000_000)
        .select(key, "live_from_us")
    )


def recent_video_scores(interactions: DataFrame, as_of: Column, ttl: int = V.RECENT_TTL, n: int = 50) -> DataFrame:
    """Top n of each user's live score set; the last write per video counts.

    A video is in the live set exactly when its last write is, so the last
    write per (user, video) is taken first and only that joins the sessions.
    """
    past = interactions.filter(F.col("event_time") <= as_of)
    us = micros(F.col("event_time"))
    last = past.groupBy("user_id", "video_id").agg(
        F.max_by("weight", F.struct(us, F.col("event_type"))).alias("score"), F.max(us).alias("written_us")
    )
    live = live_since(interactions, "user_id", ttl, as_of)
    held = last.join(live, "user_id").filter(F.col("written_us") >= F.col("live_from_us"))
    order = [F.col("score").desc(), F.col("video_id")]
    return top_per_key(held, "user_id", order, n).select("user_id", "video_id", "score", "rank")


def video_counters(interactions: DataFrame, as_of: Column, ttl: int = V.COUNTER_TTL) -> DataFrame:
    """Events per video and type since the video's counters were last dropped."""
    past = interactions.filter(F.col("event_time") <= as_of)
    counts = past.groupBy(
        "video_id",
        "event_type",
        F.floor(micros(F.col("event_time")) / (ttl * 1_000_000)).alias("_bucket"),
    ).agg(F.max(micros(F.col("event_time"))).alias("last_us"), F.count("*").alias("n"))
    live = live_since(interactions, "video_id", ttl, as_of)
    return (
        counts.join(live, "video_id")
        .filter(F.col("last_us") >= F.col("live_from_us"))
        .groupBy("video_id", "event_type")
        .agg(F.sum("n").alias("events"))
    )
