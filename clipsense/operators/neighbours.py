"""Users who act on the same videos."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsense.operators.pairs import HOLDER_LIMIT, Groups, all_products, grouped_partners, top_partners


def user_video_counts(events: DataFrame, distinct: bool = False) -> DataFrame:
    """(entity, feature, value) = (user, video, number of events).

    Repeats multiply in the common count, as in a plain join of the events;
    ``distinct`` counts each (user, video) once instead.
    """
    value = F.lit(1.0) if distinct else F.count("*").cast("double")
    return (
        events.groupBy(F.col("user_id").alias("entity"), F.col("video_id").alias("feature"))
        .agg(value.alias("value"))
    )


def common_counts(events: DataFrame, limit: int = HOLDER_LIMIT) -> DataFrame:
    """Common count of every two users with a common video.

    The result itself holds all pairs; ``top_neighbours`` is the form that
    stays small when one video is everybody's.
    """
    return all_products(user_video_counts(events), limit).select(
        F.col("left").alias("user_id"), F.col("right").alias("neighbour_id"),
        F.col("product").cast("bigint").alias("common"),
    )


def top_neighbours(events: DataFrame, k: int, distinct: bool = False, limit: int = HOLDER_LIMIT, grouped: bool = True) -> DataFrame:
    """The k users with the largest common count, for every user. Without ``grouped`` no users with the same events are looked for."""
    return top_partners(user_video_counts(events, distinct), k, limit, grouped=grouped).select(
        F.col("left").alias("user_id"), F.col("right").alias("neighbour_id"),
        F.col("product").cast("bigint").alias("common"), "rank",
    )


def neighbour_groups(events: DataFrame, k: int, limit: int = HOLDER_LIMIT) -> Groups | None:
    """The k neighbours of users with the same events, once for all of them; None where few users have the same."""
    return grouped_partners(user_video_counts(events), k, limit)


def candidates(neighbours: DataFrame, events: DataFrame) -> DataFrame:
    """Videos of each user's neighbours, with counts summed over the neighbours.

    The neighbours' events are counted per (user, video) before the join.
    """
    cells = events.groupBy(F.col("user_id").alias("neighbour_id"), "video_id").agg(
        F.count("*").alias("n"),
        F.sum("completion_rate").alias("share"),
        F.count("completion_rate").alias("share_n"),
    )
    return (
        neighbours.select("user_id", "neighbour_id", "common")
        .join(cells, "neighbour_id")
        .groupBy("user_id", "video_id")
        .agg(
            F.sum("n").alias("events"),
            F.sum(F.col("n") * F.col("common")).alias("common_sum"),
            F.max("common").alias("common_max"),
            F.try_divide(F.sum("share"), F.sum("share_n")).alias("avg_completion"),
        )
    )


def exclude_seen(pairs: DataFrame, interactions: DataFrame) -> DataFrame:
    """Drop pairs whose user has any event on the video."""
    seen = interactions.select("user_id", "video_id").distinct()
    return pairs.join(seen, ["user_id", "video_id"], "left_anti")


def attach_video_stats(pairs: DataFrame, quality: DataFrame) -> DataFrame:
    return pairs.join(quality.select("video_id", "quality_score"), "video_id")
