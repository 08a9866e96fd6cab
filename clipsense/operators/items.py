"""Per-item statistics, trending lists, counters over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsense import fixed_values as V
from clipsense.functions.items import engagement_score, quality_score
from clipsense.functions.rules import micros
from clipsense.operators.ranking import ranked_top, top


def count_of(event_type: str) -> Column:
    return F.count(F.when(F.col("event_type") == event_type, 1))


def video_stats(interactions: DataFrame) -> DataFrame:
    is_view = F.col("event_type") == "view"
    return interactions.groupBy("video_id").agg(
        count_of("view").alias("view_count"),
        count_of("like").alias("like_count"),
        count_of("comment").alias("comment_count"),
        count_of("share").alias("share_count"),
        F.avg(F.when(is_view, F.col("completion_rate"))).alias("avg_completion_rate"),
        F.count_distinct("user_id").alias("unique_viewers"),
    )


def video_quality(stats: DataFrame) -> DataFrame:
    return stats.withColumn("engagement_score", engagement_score()).withColumn("quality_score", quality_score())


def since(interactions: DataFrame, as_of: Column, hours: int) -> DataFrame:
    """Events of the last hours; a literal ``as_of`` reaches the scan as a filter."""
    cutoff = as_of - F.make_dt_interval(hours=F.lit(hours))
    return interactions.filter(F.col("event_time") >= cutoff)


def trending(interactions: DataFrame, as_of: Column, hours: int = 24, n: int = 20) -> DataFrame:
    """Top n videos of the last hours by sum of weights."""
    sums = since(interactions, as_of, hours).groupBy("video_id").agg(
        F.count("*").alias("interaction_count"), F.sum("weight").alias("score")
    )
    return ranked_top(sums, "score", "video_id", n)


def popular_by_count(interactions: DataFrame, n: int = 100) -> DataFrame:
    return top(interactions.groupBy("video_id").agg(F.count("*").alias("interactions")), "interactions", "video_id", n)


def event_breakdown(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("event_type").agg(F.count("*").alias("events"))


def _cells(interactions: DataFrame) -> DataFrame:
    """Counts per (user, video): what every table-wide figure can start from."""
    return interactions.groupBy("user_id", "video_id").agg(
        F.count("*").alias("events"), count_of("view").alias("views"), count_of("like").alias("likes")
    )


def dataset_summary(interactions: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row: sizes, distinct users and videos, views and likes per video."""
    videos = catalog.agg(F.count("*")).scalar()
    return _cells(interactions).agg(
        F.sum("events").alias("total_interactions"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("video_id").alias("unique_videos"),
        F.try_divide(F.sum("views"), videos).alias("avg_views_per_video"),
        F.try_divide(F.sum("likes"), videos).alias("avg_likes_per_video"),
    ).withColumn("total_videos", videos)


def system_stats(users: DataFrame, catalog: DataFrame, interactions: DataFrame, as_of: Column, idle: int = V.SESSION_GAP) -> DataFrame:
    """One row of table sizes, and of users active within the session gap."""
    recent = F.when(micros(as_of) - micros(F.col("event_time")) <= idle * 1_000_000, F.col("user_id"))
    return interactions.agg(
        F.count("*").alias("total_interactions"), F.count_distinct(recent).alias("active_sessions")
    ).select(
        users.agg(F.count("*")).scalar().alias("total_users"),
        catalog.agg(F.count("*")).scalar().alias("total_videos"),
        "total_interactions",
        "active_sessions",
    )


def run_summary(interactions: DataFrame, quality: DataFrame) -> DataFrame:
    """One row on a whole batch run: best quality, mean engagement, sizes."""
    best = quality.agg(
        F.max("quality_score").alias("max_quality_score"),
        F.avg("engagement_score").alias("avg_engagement_score"),
        F.count("*").alias("videos_analyzed"),
    )
    sizes = interactions.agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("interactions"))
    return best.withColumn("sizes", sizes.select(F.struct("*")).scalar()).select(*best.columns, "sizes.*")


def sparsity(interactions: DataFrame) -> DataFrame:
    """Empty share of the user-item matrix, counting rows and distinct pairs.

    The row form goes below 0 when pairs repeat; the pair form cannot.
    """
    sizes = _cells(interactions).agg(
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("video_id").alias("videos"),
        F.sum("events").alias("interactions"),
        F.count("*").alias("pairs"),
    )
    area = F.col("users") * F.col("videos")
    return sizes.select(
        "*",
        (1 - F.col("interactions") / area).alias("sparsity"),
        (1 - F.col("pairs") / area).alias("pair_sparsity"),
    )


def item_user_weights(interactions: DataFrame) -> DataFrame:
    """The item-user matrix in long form; missing cells are zero."""
    return interactions.groupBy("video_id", "user_id").agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("weight"))


def item_user_pivot(interactions: DataFrame, users: list[str]) -> DataFrame:
    """Dense columns for a named list of users (Spark limits their number)."""
    return interactions.groupBy("video_id").pivot("user_id", users).agg(F.sum("weight")).na.fill(0.0)


def distinct_keys(interactions: DataFrame, key: str) -> DataFrame:
    return interactions.select(key).distinct()


def sample_users(interactions: DataFrame, n: int = 100) -> DataFrame:
    return distinct_keys(interactions, "user_id").orderBy("user_id").limit(n)


def union_interactions(*parts: DataFrame) -> DataFrame:
    """By column name; the parts list their columns in different orders."""
    first, *others = parts
    for part in others:
        first = first.unionByName(part)
    return first


def ratings(interactions: DataFrame) -> DataFrame:
    """Repeat count per pair as rating, with the mean time in milliseconds."""
    millis = micros(F.col("event_time")) / 1000
    return interactions.groupBy("user_id", "video_id").agg(
        F.count("*").cast("double").alias("rating"), F.avg(millis).alias("timestamp")
    )


def rating_distribution(rated: DataFrame) -> DataFrame:
    return rated.agg(
        F.count("rating").alias("count"),
        F.avg("rating").alias("mean"),
        F.stddev("rating").alias("stddev"),
        F.min("rating").alias("min"),
        F.max("rating").alias("max"),
    )
