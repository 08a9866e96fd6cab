"""Whole batch runs: load, profile, recommend. Each step writes its own table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsense import fixed_values as V
from clipsense.ml import als
from clipsense.ml.clusters import segments
from clipsense.operators import catalog as cat
from clipsense.operators import items, loading, profiles, recommend
from clipsense.sinks import tables
from clipsense.sources import files


def load_data_set(spark: SparkSession, folder: str, out: str, as_of: Column, *, pairs: str = "pairs.csv", titles: str = "titles.csv", likes_views: str = "likes_views.tsv", tags: str = "tags.csv", comments: str = "comments.tsv") -> DataFrame:
    """Text files to the ``videos`` and ``interactions`` tables; returns the summary."""
    rows = files.pairs_csv(spark, f"{folder}/{pairs}")
    videos = cat.with_derived(
        cat.catalog_join(
            rows,
            files.titles_csv(spark, f"{folder}/{titles}"),
            files.likes_views_tsv(spark, f"{folder}/{likes_views}"),
            files.tags_csv(spark, f"{folder}/{tags}"),
        )
    )
    tables.overwrite(videos, out, "videos")
    views = loading.view_events(rows)
    talk = loading.comment_events(files.comments_tsv(spark, f"{folder}/{comments}"), as_of).drop("comment_length")
    every = items.union_interactions(views, talk, loading.like_events(views), loading.share_events(views))
    tables.overwrite(every, out, "interactions", partition_by=["event_type"])
    stored = files.collection(spark, out, "interactions")
    return items.dataset_summary(stored, files.collection(spark, out, "videos"))


def profile_users(spark: SparkSession, interactions: DataFrame, catalog: DataFrame, out: str) -> DataFrame:
    """Profiles, preferences and segments to ``user_profiles``; returns the insights."""
    base = profiles.full_user_profile(interactions, catalog)
    clustered = tables.drop_vectors(segments(base))
    tops = profiles.top_tags(profiles.tag_affinity(interactions, catalog))
    preferred = profiles.preferred_tags(profiles.tag_counts(interactions, catalog))
    tables.overwrite(profiles.full_profiles(clustered, tops, preferred), out, "user_profiles")
    return profiles.insights(files.collection(spark, out, "user_profiles"))


def recommend_all(spark: SparkSession, interactions: DataFrame, catalog: DataFrame, out: str, generated_at: Column, n: int = 20, **als_settings) -> DataFrame:
    """Profiling, video quality, ALS and hybrid lists of all users; returns the summary."""
    profile_users(spark, interactions, catalog, out)
    tables.overwrite(items.video_quality(items.video_stats(interactions)), out, "video_quality")
    quality = files.collection(spark, out, "video_quality")
    stored_profiles = files.collection(spark, out, "user_profiles")
    model = als.train(interactions.select("user_id", "video_id", "weight"), **als_settings)
    flat = model.for_all(n).select(
        "user_id", "video_id", "score", F.array(F.lit(V.ALS_METHOD)).alias("methods"),
        generated_at.alias("generated_at"), F.lit("als").alias("algorithm"),
    )
    tables.append(flat, out, "recommendations", partition_by=["algorithm"])
    mixed = recommend.hybrid(interactions, stored_profiles, quality, n)
    tables.append(recommend.recommendation_rows(mixed, generated_at), out, "recommendations", partition_by=["algorithm"])
    return items.run_summary(interactions, quality)
