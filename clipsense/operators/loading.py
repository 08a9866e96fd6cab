"""Raw rows of a data set to interaction events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsense import fixed_values as V
from clipsense.functions.events import has_required_fields, topic
from clipsense.functions.rules import hash_fraction
from clipsense.functions.weights import loader_weight

COLUMNS = (
    "user_id", "video_id", "event_type", "event_time", "weight",
    "watch_time", "total_duration", "completion_rate",
)


def _without_watch(rows: DataFrame, event_type: str, event_time: Column, *extra: str) -> DataFrame:
    kind = F.lit(event_type)
    return rows.select(
        "user_id",
        "video_id",
        kind.alias("event_type"),
        event_time.alias("event_time"),
        loader_weight(kind).alias("weight"),
        *[F.lit(None).cast("double").alias(name) for name in COLUMNS[5:]],
        *extra,
    )


def view_events(pairs: DataFrame) -> DataFrame:
    """Pairs to views. The watch time is drawn from a hash of the row's key,
    so that every run and every action sees the same one."""
    draw = hash_fraction("watch", F.col("user_id"), F.col("video_id"), F.col("timestamp"))
    watch = F.lit(V.WATCH_TIME_LOW) + draw * V.WATCH_TIME_SPAN
    kind = F.lit("view")
    return pairs.select(
        "user_id",
        "video_id",
        kind.alias("event_type"),
        F.timestamp_millis("timestamp").alias("event_time"),
        loader_weight(kind).alias("weight"),
        watch.alias("watch_time"),
        F.lit(V.DEFAULT_DURATION).alias("total_duration"),
        (watch / V.DEFAULT_DURATION).alias("completion_rate"),
    )


def comment_events(comments: DataFrame, as_of: Column) -> DataFrame:
    """Comments carry no time of their own; ``as_of`` stamps them."""
    sized = comments.withColumn("comment_length", F.length("comment_content"))
    return _without_watch(sized, "comment", as_of, "comment_length")


def _sampled(views: DataFrame, event_type: str, rule: tuple[float, float]) -> DataFrame:
    completion, share = rule
    draw = hash_fraction(event_type, F.col("user_id"), F.col("video_id"), F.unix_millis("event_time"))
    kept = views.filter((F.col("completion_rate") >= completion) & (draw < share))
    return _without_watch(kept, event_type, F.col("event_time"))


def like_events(views: DataFrame) -> DataFrame:
    return _sampled(views, "like", V.LIKE_SAMPLE)


def share_events(views: DataFrame) -> DataFrame:
    return _sampled(views, "share", V.SHARE_SAMPLE)


def validate(events: DataFrame, received_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Events with all required fields, and the others; both with the time of their arrival, if it is given."""
    if received_at is not None:
        events = events.withColumn("received_at", received_at)
    return events.filter(has_required_fields()), events.filter(~has_required_fields())


def route(events: DataFrame) -> DataFrame:
    return events.withColumn("topic", topic(F.col("event_type")))
