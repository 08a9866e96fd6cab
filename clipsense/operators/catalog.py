"""The item catalog: building it, and joining it to events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsense.functions.items import engagement_ratio, matches, media_url
from clipsense.operators.ranking import top, top_per_key


def _one_per_video(df: DataFrame) -> DataFrame:
    """The smallest row per id: repeatable, and no copy can fan a join out."""
    rest = [c for c in df.columns if c != "video_id"]
    return df.groupBy("video_id").agg(F.min(F.struct(*rest)).alias("row")).select("video_id", "row.*")


def catalog_join(video_ids: DataFrame, titles: DataFrame, likes_views: DataFrame, tags: DataFrame) -> DataFrame:
    """Every id that occurs, with what is known about it."""
    catalog = video_ids.select("video_id").distinct()
    for side in (titles, likes_views, tags):
        catalog = catalog.join(_one_per_video(side), "video_id", "left")
    return catalog


def with_derived(catalog: DataFrame) -> DataFrame:
    """Add the like ratio and the links."""
    return catalog.select(
        "*",
        engagement_ratio(F.col("likes"), F.col("views")).alias("engagement_score"),
        media_url(F.col("video_id"), "stream").alias("video_url"),
        media_url(F.col("video_id"), "cover").alias("cover_url"),
    )


def enrich_interactions(interactions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog columns on every event. Catalog size decides the join, not a hint."""
    return interactions.join(catalog, "video_id", "left")


def interactions_with_tags(interactions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Only events whose video the catalog knows."""
    return interactions.join(catalog.select("video_id", "tags"), "video_id")


def enrich_recommendations(recs: DataFrame, catalog: DataFrame, columns: tuple[str, ...] = ("title", "tags", "views", "likes")) -> DataFrame:
    return recs.join(catalog.select("video_id", *columns), "video_id", "left")


def search(catalog: DataFrame, query: str, columns: tuple[str, ...] = ("title", "video_id", "category")) -> DataFrame:
    return catalog.filter(matches(query, *map(F.col, columns)))


def lookup_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def popular_by_category(catalog: DataFrame, n: int = 20, category: str | None = None) -> DataFrame:
    """Top n by engagement score, in one category or in each."""
    order = [F.col("engagement_score").desc_nulls_last(), F.col("video_id")]
    if category is not None:
        return top(catalog.filter(F.col("category") == category), "engagement_score", "video_id", n)
    return top_per_key(catalog, "category", order, n)


def popular_by_views(catalog: DataFrame, n: int = 20) -> DataFrame:
    return top(catalog, "views", "video_id", n)
