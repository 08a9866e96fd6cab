"""Recommendations for all users at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipsense import fixed_values as V
from clipsense.functions.users import diversity_bonus, method_weight
from clipsense.operators.neighbours import exclude_seen, neighbour_groups, top_neighbours
from clipsense.operators.offers import best_group_offers, best_offers
from clipsense.operators.pairs import HOLDER_LIMIT, split_by_holders
from clipsense.operators.ranking import top_per_key
from clipsense.session import staged


def _by_neighbours(alike: DataFrame, offered: DataFrame, interactions: DataFrame, quality: DataFrame, score, n: int, k: int, limit: int, blocks: dict) -> DataFrame:
    """Offered by the users who share most of ``alike``, not seen yet."""
    groups = neighbour_groups(alike, k, limit)
    if groups is None:
        return best_offers(top_neighbours(alike, k, limit=limit, grouped=False), offered, interactions, quality, score, n, **blocks)
    return best_group_offers(groups, offered, interactions, quality, score, n, **blocks)


def by_likes(interactions: DataFrame, quality: DataFrame, n: int = 20, k: int = V.LIKE_NEIGHBOURS, limit: int = HOLDER_LIMIT, **blocks) -> DataFrame:
    """Liked by users with common likes, not seen yet. ``blocks`` are settings of ``best_offers``."""
    likes = interactions.filter(F.col("event_type") == "like")
    return _by_neighbours(likes, likes, interactions, quality, likes_score, n, k, limit, blocks)


def by_comments(interactions: DataFrame, quality: DataFrame, n: int = 20, k: int = V.COMMENT_NEIGHBOURS, limit: int = HOLDER_LIMIT, **blocks) -> DataFrame:
    """Liked or commented by users with common comments, not seen yet."""
    comments = interactions.filter(F.col("event_type") == "comment")
    offered = interactions.filter(F.col("event_type").isin("like", "comment"))
    return _by_neighbours(comments, offered, interactions, quality, comments_score, n, k, limit, blocks)


def completed_views(interactions: DataFrame, at_least: float) -> DataFrame:
    return interactions.filter((F.col("event_type") == "view") & (F.col("completion_rate") >= at_least))


def by_watch(interactions: DataFrame, quality: DataFrame, n: int = 20, k: int = V.WATCH_NEIGHBOURS, limit: int = HOLDER_LIMIT, **blocks) -> DataFrame:
    """Watched through by users who watch the same videos through, not seen yet."""
    alike = completed_views(interactions, V.WATCH_SIMILAR_COMPLETION)
    offered = completed_views(interactions, V.WATCH_CANDIDATE_COMPLETION)
    return _by_neighbours(alike, offered, interactions, quality, watch_score, n, k, limit, blocks)


# Scores of columns and of arrays alike.
def likes_score(events, common_sum, common_max, completion, quality):
    return events * common_sum * 0.7 + quality * 0.3


def comments_score(events, common_sum, common_max, completion, quality):
    return events * common_max * 0.6 + quality * 0.4


def watch_score(events, common_sum, common_max, completion, quality):
    return events * common_max * 0.5 + completion * 30 + quality * 0.3


def union_methods(likes: DataFrame, comments: DataFrame, watch: DataFrame) -> DataFrame:
    named = [
        recs.withColumn("method", F.lit(name))
        for name, recs in (("likes", likes), ("comments", comments), ("watch_patterns", watch))
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


def with_method_weights(recs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Weight each list by the user's type; no profile has weights of its own."""
    types = profiles.select("user_id", "user_type")
    return recs.join(types, "user_id", "left").withColumn(
        "method_weight", method_weight(F.col("user_type"), F.col("method"))
    )


def hybrid_scores(weighted: DataFrame) -> DataFrame:
    """Weighted sum and bonus per (user, video) over the at most three lists."""
    return (
        weighted.groupBy("user_id", "video_id")
        .agg(
            F.sum(F.col("final_score") * F.col("method_weight")).alias("total_score"),
            F.array_sort(F.collect_list("method")).alias("methods"),
            F.count("*").alias("method_count"),
        )
        .withColumn("diversity_bonus", diversity_bonus(F.col("method_count")))
        .withColumn("final_score", F.col("total_score") + F.col("diversity_bonus"))
    )


def hybrid(interactions: DataFrame, profiles: DataFrame, quality: DataFrame, n: int = 20, limit: int = HOLDER_LIMIT) -> DataFrame:
    # Three recommenders read both several times each.
    interactions = staged(interactions.select("user_id", "video_id", "event_type", "completion_rate"))
    quality = staged(quality.select("video_id", "quality_score"))
    lists = union_methods(
        by_likes(interactions, quality, n, limit=limit),
        by_comments(interactions, quality, n, limit=limit),
        by_watch(interactions, quality, n, limit=limit),
    )
    scores = hybrid_scores(with_method_weights(lists, profiles))
    order = [F.col("final_score").desc_nulls_last(), F.col("video_id")]
    return top_per_key(scores, "user_id", order, n)


def recommendation_rows(recs: DataFrame, generated_at: Column, algorithm: str = "hybrid") -> DataFrame:
    return recs.select(
        "user_id",
        "video_id",
        F.col("final_score").alias("score"),
        "methods",
        generated_at.alias("generated_at"),
        F.lit(algorithm).alias("algorithm"),
    )


def by_content(preferred: DataFrame, interactions: DataFrame, catalog: DataFrame, n: int = 20, limit: int = HOLDER_LIMIT) -> DataFrame:
    """Unseen items whose tags the user prefers, by the sum of the tag counts.

    A tag of at most ``limit`` items is joined item by item. Items are also
    grouped by their set of more frequent tags; an item that meets a user in
    frequent tags only scores like its whole group, so of each group only the
    first items can make the list. An item found both ways has its whole score
    from the first.
    """
    tagged = catalog.filter(F.col("tags").isNotNull())
    cells = tagged.select(
        F.col("video_id").alias("entity"), F.explode(F.array_distinct(F.split("tags", ","))).alias("feature")
    )
    prefs = preferred.select("user_id", F.col("tag").alias("feature"), "tag_count")
    light, heavy, _ = split_by_holders(cells, limit)
    scores = (
        prefs.join(light, "feature")
        .groupBy("user_id", F.col("entity").alias("video_id"))
        .agg(F.sum("tag_count").alias("score"))
    )
    if heavy is not None:
        groups = heavy.groupBy(F.col("entity").alias("video_id")).agg(
            F.array_join(F.array_sort(F.collect_set("feature")), ",").alias("tags")
        )
        more = _first_of_groups(prefs, groups, interactions, n)
        scores = (
            _add_frequent_tags(scores, prefs, groups)
            .unionByName(more)
            .groupBy("user_id", "video_id")
            .agg(F.max("score").alias("score"))
        )
    order = [F.col("score").desc(), F.col("video_id")]
    return top_per_key(exclude_seen(scores, interactions), "user_id", order, n)


def _add_frequent_tags(scores: DataFrame, prefs: DataFrame, groups: DataFrame) -> DataFrame:
    """Add the counts of an item's frequent tags; a user has few preferred tags."""
    counts = prefs.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "tag_count"))).alias("counts")
    )
    extra = F.aggregate(
        F.split("tags", ","), F.lit(0).cast("bigint"),
        lambda total, tag: total + F.coalesce(F.try_element_at("counts", tag), F.lit(0)),
    )
    return (
        scores.join(groups, "video_id", "left")
        .join(counts, "user_id")
        .select("user_id", "video_id", (F.col("score") + F.coalesce(extra, F.lit(0))).alias("score"))
    )


def _first_of_groups(prefs: DataFrame, items: DataFrame, interactions: DataFrame, n: int) -> DataFrame:
    """The items of each user's best tag groups that can be among the first n.

    A group is out of reach once better groups hold n unseen items. Of a group
    within reach the first n items and as many as the user has seen are enough,
    and of all these the first n and as many as the user has seen in any of the
    groups; the others do not leave the task.
    """
    kinds = items.groupBy("tags").agg(F.count("*").alias("size"))
    # Stored, so that its size is known: a small table goes to the users' rows, which are then sent once, by user.
    kind_tags = staged(kinds.select("tags", "size", F.explode(F.split("tags", ",")).alias("feature")))
    seen = interactions.select("user_id", "video_id").filter(F.col("user_id").isNotNull()).distinct().join(items, "video_id")
    seen_kinds = seen.groupBy("user_id", "tags").agg(F.count("*").alias("seen"))
    none = F.lit(None).cast("bigint")
    scored = (
        prefs.join(kind_tags, "feature")
        .groupBy("user_id", "tags")
        .agg(F.sum("tag_count").alias("score"), F.max("size").alias("size"))
        .withColumn("seen", none)
        .unionByName(seen_kinds.select("user_id", "tags", none.alias("score"), none.alias("size"), "seen"))
        .repartition("user_id")
        .groupBy("user_id", "tags")
        .agg(F.max("score").alias("score"), F.max("size").alias("size"), F.coalesce(F.max("seen"), F.lit(0)).alias("seen"))
        .filter(F.col("size").isNotNull())
        .withColumn("unseen", F.col("size") - F.col("seen"))
    )
    better = Window.partitionBy("user_id").orderBy(F.col("score").desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    peers = Window.partitionBy("user_id", "score")
    reachable = (
        scored.withColumn("up_to_here", F.sum("unseen").over(better))
        .withColumn("same_score", F.sum("unseen").over(peers))
        .filter((F.col("up_to_here") - F.col("same_score") < n) & (F.col("unseen") > 0))
        .select("user_id", "tags", "score", "seen", (n + F.sum("seen").over(Window.partitionBy("user_id"))).alias("kept"))
    )
    # Each user asks for their own places of a group, so a hot user opens no group further for others.
    asked = reachable.select("user_id", "tags", "score", "kept", F.explode(F.sequence(F.lit(1), (n + F.col("seen")).cast("int"))).alias("place"))
    depth = n + (seen_kinds.agg(F.max("seen").alias("most")).first()["most"] or 0)
    places = staged(top_per_key(items, "tags", ["video_id"], depth, "place"))
    first = F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("score").desc(), "video_id"))
    found = asked.join(places, ["tags", "place"]).withColumn("first", first)
    return found.filter(F.col("first") <= F.col("kept")).select("user_id", "video_id", "score")


def mixed(parts: dict[str, tuple[DataFrame, float]], n: int = 20) -> DataFrame:
    """Weighted mix of (user, video, score) lists, each scaled to 0..1 per user.

    A list whose scores are all equal for a user scales to 1.
    """
    scaled = None
    of_user = Window.partitionBy("user_id")
    low, high = F.min("score").over(of_user), F.max("score").over(of_user)
    unit = F.coalesce(F.try_divide(F.col("score") - low, high - low), F.lit(1.0))
    for name, (recs, weight) in parts.items():
        part = recs.select("user_id", "video_id", (unit * weight).alias("score"), F.lit(name).alias("method"))
        scaled = part if scaled is None else scaled.unionByName(part)
    sums = scaled.groupBy("user_id", "video_id").agg(
        F.sum("score").alias("score"), F.array_sort(F.collect_set("method")).alias("methods")
    )
    return top_per_key(sums, "user_id", [F.col("score").desc(), F.col("video_id")], n)
