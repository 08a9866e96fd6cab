"""Columns about items: tags, links, scores, search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipsense import fixed_values as V
from clipsense.functions.rules import weighted_sum


def parse_tags(tags: Column) -> Column:
    """Tag text to array: pipes win over commas, only comma parts are trimmed."""
    return (
        F.when(tags.isNull() | (tags == ""), F.array().cast("array<string>"))
        .when(tags.contains("|"), F.split(tags, r"\|"))
        .when(tags.contains(","), F.transform(F.split(tags, ","), lambda part: F.trim(part)))
        .otherwise(F.array(tags))
    )


def engagement_ratio(likes: Column, views: Column) -> Column:
    return likes / (views + 1) * 100


def media_url(video_id: Column, kind: str) -> Column:
    return F.concat(F.lit("/api/v1/videos/"), video_id, F.lit(f"/{kind}"))


def engagement_age_score(created_at: Column, as_of: Column) -> Column:
    """Weighted counts divided by the age in begun days, at least one.

    Age counts whole 24-hour spans, rounded down as date arithmetic does.
    """
    days = F.floor(F.timestamp_diff("SECOND", created_at, as_of) / F.lit(86_400))
    return weighted_sum(V.AGE_SCORE_COUNTS) / F.greatest(F.lit(1), days + 1)


def engagement_score() -> Column:
    """Likes, comments and shares per view, from the item counts."""
    return weighted_sum(V.ENGAGEMENT_COUNTS) / (F.col("view_count") + 1)


def quality_score() -> Column:
    """NULL while an item has no completion, and so last in every ranking."""
    return (
        F.col("avg_completion_rate") * V.QUALITY_COMPLETION
        + F.col("engagement_score") * V.QUALITY_ENGAGEMENT
        + F.log1p(F.col("unique_viewers")) * V.QUALITY_REACH
    )


def matches(query: str, *columns: Column) -> Column:
    """Case-insensitive containment in any of the columns; NULL matches nothing."""
    needle = F.lower(F.lit(query))
    tests = [F.coalesce(F.lower(c).contains(needle), F.lit(False)) for c in columns]
    return reduce(lambda a, b: a | b, tests)
