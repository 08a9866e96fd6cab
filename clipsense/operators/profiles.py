"""User profiles, tag preferences, insights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipsense import fixed_values as V
from clipsense.functions.users import engagement_rate, user_score, user_type
from clipsense.operators.items import count_of
from clipsense.operators.ranking import top_per_key


def _user_video_cells(interactions: DataFrame) -> DataFrame:
    """One row per (user, video): repeated events are reduced before any join."""
    is_view = F.col("event_type") == "view"
    watch, share = F.col("watch_time"), F.col("completion_rate")
    return interactions.groupBy("user_id", "video_id").agg(
        F.count("*").alias("events"),
        *[count_of(t).alias(f"n_{t}") for t in V.PROFILE_EVENT_TYPES],
        F.sum(F.when(is_view, watch)).alias("view_watch"),
        F.count(F.when(is_view, watch)).alias("view_watch_n"),
        F.sum(F.when(is_view, share)).alias("view_share"),
        F.count(F.when(is_view, share)).alias("view_share_n"),
        F.sum(watch).alias("watch"),
        F.count(watch).alias("watch_n"),
        F.sum(share).alias("share"),
        F.count(share).alias("share_n"),
        F.min("event_time").alias("first"),
        F.max("event_time").alias("last"),
    )


def _mean(total: str, n: str):
    return F.try_divide(F.sum(total), F.sum(n))


def user_profile(interactions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Counts, means, diversity and first/last event per user.

    The tag strings a user met are kept as rows by ``watched_tags``; a list
    inside the profile would grow with a hot user's history.
    """
    tagged = _user_video_cells(interactions).join(catalog.select("video_id", "tags"), "video_id", "left")
    return tagged.groupBy("user_id").agg(
        F.sum("n_view").alias("total_views"),
        _mean("view_watch", "view_watch_n").alias("avg_watch_time"),
        _mean("view_share", "view_share_n").alias("avg_completion_rate"),
        F.sum("n_like").alias("total_likes"),
        F.sum("n_comment").alias("total_comments"),
        F.sum("n_share").alias("total_shares"),
        F.sum("n_collect").alias("total_collects"),
        F.count("video_id").alias("unique_videos_watched"),
        F.count_distinct("tags").alias("unique_categories"),
        F.min("first").alias("first_interaction"),
        F.max("last").alias("last_interaction"),
    )


def watched_tags(interactions: DataFrame, catalog: DataFrame) -> DataFrame:
    """How often each user met each tag string."""
    cells = interactions.groupBy("user_id", "video_id").agg(F.count("*").alias("events"))
    return (
        cells.join(catalog.select("video_id", "tags"), "video_id")
        .filter(F.col("tags").isNotNull())
        .groupBy("user_id", "tags")
        .agg(F.sum("events").alias("times"))
    )


def derived(profiles: DataFrame) -> DataFrame:
    """Engagement rate, days between first and last event, views per day."""
    days = F.datediff("last_interaction", "first_interaction") + 1
    return (
        profiles.withColumn("engagement_rate", engagement_rate())
        .withColumn("active_days", days)
        .withColumn("activity_frequency", F.col("total_views") / (F.col("active_days") + 1))
    )


def scored(profiles: DataFrame, null_as_max: bool = False) -> DataFrame:
    return profiles.withColumn("user_score", user_score(null_as_max)).withColumn(
        "user_type", user_type(F.col("user_score"))
    )


def full_user_profile(interactions: DataFrame, catalog: DataFrame, null_as_max: bool = False) -> DataFrame:
    return scored(derived(user_profile(interactions, catalog)), null_as_max)


def fill_features(profiles: DataFrame) -> DataFrame:
    return profiles.na.fill(0, list(V.CLUSTER_FEATURES))


def tag_affinity(interactions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per user and tag string: events of any type, means, score."""
    tagged = _user_video_cells(interactions).join(catalog.select("video_id", "tags"), "video_id")
    return (
        tagged.groupBy("user_id", "tags")
        .agg(
            F.sum("events").alias("view_count"),
            _mean("watch", "watch_n").alias("avg_watch_time"),
            _mean("share", "share_n").alias("avg_completion_rate"),
        )
        .withColumn("tags_score", F.col("view_count") * F.col("avg_completion_rate") * 100)
    )


def tag_counts(interactions: DataFrame, catalog: DataFrame, trim_tags: bool = False) -> DataFrame:
    """Events per user and single tag. Parts keep their blanks unless trimmed."""
    part = F.explode(F.split("tags", ","))
    return (
        watched_tags(interactions, catalog)
        .select("user_id", part.alias("tag"), "times")
        .withColumn("tag", F.trim("tag") if trim_tags else F.col("tag"))
        .groupBy("user_id", "tag")
        .agg(F.sum("times").alias("tag_count"))
    )


def top_tags(affinity: DataFrame, k: int = 5) -> DataFrame:
    order = [F.col("tags_score").desc_nulls_last(), F.col("tags")]
    return top_per_key(affinity, "user_id", order, k)


def preferred_tags(counts: DataFrame, k: int = 10) -> DataFrame:
    return top_per_key(counts, "user_id", [F.col("tag_count").desc(), F.col("tag")], k)


def as_list(ranked: DataFrame, name: str, *fields: str) -> DataFrame:
    """At most k ranked rows per user, as one array in rank order."""
    items = F.array_sort(F.collect_list(F.struct("rank", *[f for f in fields if f != "rank"])))
    return ranked.groupBy("user_id").agg(items.alias("items")).select(
        "user_id",
        F.transform("items", lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(name),
    )


def full_profiles(profiles: DataFrame, ranked_tags: DataFrame, preferred: DataFrame) -> DataFrame:
    tops = as_list(ranked_tags.select("user_id", "rank", "tags", "tags_score"), "top_categories", "tags", "tags_score")
    tags = as_list(preferred, "preferred_tags", "tag", "tag_count", "rank")
    return profiles.join(tops, "user_id", "left").join(tags, "user_id", "left")


def profile_view(profiles: DataFrame, ranked_tags: DataFrame, recent: DataFrame) -> DataFrame:
    """One row per user: profile, favourite categories, recent events."""
    tops = as_list(ranked_tags, "favorite_categories", "tags")
    events = as_list(recent, "recent_interactions", "video_id", "event_type", "event_time", "weight")
    return profiles.join(tops, "user_id", "left").join(events, "user_id", "left")


def insights(profiles: DataFrame) -> DataFrame:
    """One row per user type, each with the overall means beside it."""
    means = {"avg_user_score": "user_score", "avg_engagement_rate": "engagement_rate", "avg_views_per_user": "total_views"}
    kinds = profiles.groupBy("user_type").agg(
        F.count("*").alias("users"), F.count("user_id").alias("known"),
        *[F.sum(c).alias(f"{name}_sum") for name, c in means.items()], *[F.count(c).alias(f"{name}_n") for name, c in means.items()],
    )
    # A handful of rows, one for each type.
    every = Window.partitionBy()
    return kinds.select(
        "user_type", "users",
        *[F.try_divide(F.sum(f"{name}_sum").over(every), F.sum(f"{name}_n").over(every)).alias(name) for name in means],
        F.sum("known").over(every).alias("total_users"),
    )


def profile_or_default(users: DataFrame, counters: DataFrame, as_of) -> DataFrame:
    """The stored counters of each user, or those of a new one."""
    stored = counters.select("user_id", "total_interactions", "last_activity", "favorite_categories")
    return users.select("user_id").join(stored, "user_id", "left").select(
        "user_id",
        F.coalesce("total_interactions", F.lit(0)).alias("total_interactions"),
        "last_activity",
        F.coalesce("favorite_categories", F.array().cast("array<string>")).alias("favorite_categories"),
        F.when(F.col("total_interactions").isNull(), as_of).alias("created_at"),
    )
