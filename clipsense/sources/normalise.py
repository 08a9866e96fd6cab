"""Foreign field names to the common item and interaction schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsense import fixed_values as V
from clipsense.functions.events import completion, rating_event_type
from clipsense.functions.items import parse_tags

# Candidate field names in order, type and default of each output column.
ITEM_FIELDS = {
    "video_id": (("video_id", "id", "item_id"), "string", ""),
    "title": (("title", "name"), "string", "Untitled"),
    "creator_id": (("creator_id", "author_id"), "string", "unknown"),
    "category": (("category", "tag", "genre"), "string", "general"),
    "duration": (("duration", "length"), "double", V.DEFAULT_ITEM_DURATION),
    "view_count": (("view_count", "views"), "bigint", 0),
    "like_count": (("like_count", "likes"), "bigint", 0),
    "share_count": (("share_count",), "bigint", 0),
    "comment_count": (("comment_count",), "bigint", 0),
    "created_at": (("upload_time", "created_at"), "string", ""),
    "description": (("description",), "string", ""),
    "resolution": (("resolution",), "string", "1080p"),
    "language": (("language",), "string", "en"),
}
TAG_FIELDS = ("tags", "hashtags", "genres")
INTERACTION_FIELDS = {
    "user_id": (("user_id",), "string", ""),
    "video_id": (("video_id", "item_id"), "string", ""),
    "timestamp": (("timestamp",), "string", ""),
    "watch_time": (("watch_time", "duration"), "double", 0.0),
    "rating": (("rating",), "double", 1.0),
}
TYPE_FIELDS = ("interaction_type", "type")


def _first(df: DataFrame, names: tuple[str, ...], kind: str, default) -> Column:
    known = [F.col(n).try_cast(kind) for n in names if n in df.columns]
    return F.coalesce(*known, F.lit(default).cast(kind))


def items(df: DataFrame) -> DataFrame:
    tags = [F.col(n) for n in TAG_FIELDS if n in df.columns]
    if tags and dict(df.dtypes)[next(n for n in TAG_FIELDS if n in df.columns)].startswith("array"):
        tag_column = F.coalesce(*tags, F.array().cast("array<string>"))
    else:
        tag_column = parse_tags(F.coalesce(*tags, F.lit("")))
    return df.select(
        *[_first(df, *spec).alias(name) for name, spec in ITEM_FIELDS.items()],
        tag_column.alias("tags"),
    )


def interactions(df: DataFrame) -> DataFrame:
    """One event type per row: the given one, else derived from a rating."""
    given = [F.col(n).cast("string") for n in TYPE_FIELDS if n in df.columns]
    rating = F.col("rating").try_cast("double") if "rating" in df.columns else F.lit(None).cast("double")
    fallback = rating_event_type(rating) if "rating" in df.columns or not given else F.lit("view")
    return df.select(
        *[_first(df, *spec).alias(name) for name, spec in INTERACTION_FIELDS.items()],
        F.coalesce(*given, fallback).alias("event_type"),
    )


def to_events(df: DataFrame) -> DataFrame:
    """Interaction rows to event rows, with the completion rate filled in."""
    duration = F.col("duration") if "duration" in df.columns else F.lit(None).cast("double")
    return df.select(
        F.coalesce(F.col("event_type"), F.lit("view")).alias("event_type"),
        "user_id",
        "video_id",
        "timestamp",
        "watch_time",
        F.coalesce(duration, F.lit(V.DEFAULT_DURATION)).alias("total_duration"),
    ).withColumn("completion_rate", completion(F.col("watch_time"), F.col("total_duration")))


def flag_events(rows: DataFrame) -> DataFrame:
    """One event per flag that is set on an exposure row."""
    keys = ["user_id", "pid", "exposed_time", "watch_time"]
    flags = list(V.FLAG_EVENTS)
    kinds = F.create_map(*[F.lit(x) for pair in V.FLAG_EVENTS.items() for x in pair])
    return (
        rows.unpivot(keys, flags, "flag", "is_set")
        .filter("is_set")
        .select(
            "user_id",
            F.col("pid").alias("video_id"),
            kinds[F.col("flag")].alias("event_type"),
            F.timestamp_seconds("exposed_time").alias("event_time"),
            F.when(F.col("flag") == "effective_view", F.col("watch_time")).alias("watch_time"),
        )
    )


def with_attributes(flagged: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Flag events with the attributes of their items and users, one row for each id.

    The duration of the item completes a watch time to a completion rate.
    """
    own_items = items.withColumnRenamed("pid", "video_id").dropDuplicates(["video_id"])
    joined = flagged.join(own_items, "video_id", "left").join(users.dropDuplicates(["user_id"]), "user_id", "left")
    return joined.withColumn("completion_rate", completion(F.col("watch_time"), F.col("duration")))
