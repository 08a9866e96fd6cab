"""What a user is shown: the best source that has something for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipsense.operators.ranking import top_per_key
from clipsense.session import staged

_COLUMNS = ("user_id", "video_id", "score", "method", "tier")


def _tier(recs: DataFrame, method: str, tier: int) -> DataFrame:
    return recs.select("user_id", "video_id", "score", F.lit(method).alias("method"), F.lit(tier).alias("tier"))


def first_tier(users: DataFrame, tiers: list[tuple[str, DataFrame]], shared: list[tuple[str, DataFrame]], n: int = 20) -> DataFrame:
    """Per user the first tier with rows, else the first ``shared`` list that is not empty.

    A shared list has at most n rows. The one that is shown travels as one array
    value, in order, to the users without rows of their own, so no user table is
    multiplied out before the result, and their rows are not sorted again. A user
    who is given m times has every place of it m times, up to n rows.
    """
    own = None
    for number, (method, recs) in enumerate(tiers):
        part = _tier(recs, method, number)
        own = part if own is None else own.unionByName(part)
    # Read for the rows and for the users without any; a list of a model is a whole product.
    own = staged(own.join(users.select("user_id"), "user_id", "left_semi"))
    lowest = F.min("tier").over(Window.partitionBy("user_id"))
    served = own.withColumn("lowest", lowest).filter("tier = lowest").select(*_COLUMNS)
    lists = [
        _tier(recs.select(F.lit("").alias("user_id"), "video_id", "score"), method, len(tiers) + number)
        .orderBy(F.col("score").desc(), "video_id").limit(n)
        for number, (method, recs) in enumerate(shared)
    ]
    every_list = lists[0]
    for part in lists[1:]:
        every_list = every_list.unionByName(part)
    # At most n rows of each list.
    order = [F.col("score").desc_nulls_last(), F.col("video_id")]
    places = every_list.withColumn("score", F.col("score").cast("double")).withColumn("place", F.row_number().over(Window.partitionBy("tier").orderBy(*order)))
    shown = places.groupBy("tier").agg(F.array_sort(F.collect_list(F.struct("place", "video_id", "score", "method"))).alias("list"))
    as_array = shown.agg(F.min_by("list", "tier").alias("list"))
    ranks = F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(n).cast("bigint"), F.size("list") * F.col("times")))
    fallback = (
        users.select("user_id")
        .join(own.select("user_id"), "user_id", "left_anti")
        .groupBy("user_id").agg(F.count("*").alias("times"))
        .withColumn("list", as_array.scalar())
        .filter(F.size("list") > 0)
        .select("user_id", "list", "times", F.explode(ranks).alias("rank"))
        .withColumn("item", F.element_at("list", F.ceil(F.col("rank") / F.col("times")).cast("int")))
        .select("user_id", "item.video_id", "item.score", "item.method", F.lit(len(tiers)).alias("tier"), F.col("rank").cast("int").alias("rank"))
    )
    return top_per_key(served, "user_id", order, n).unionByName(fallback)


def by_views(interactions: DataFrame) -> DataFrame:
    """Videos by their number of views, for days on which nothing trends."""
    views = F.count(F.when(F.col("event_type") == "view", 1)).cast("double")
    return interactions.groupBy("video_id").agg(views.alias("score"))


def by_engagement(catalog: DataFrame) -> DataFrame:
    """Videos by the engagement score of the catalog; none counts as zero."""
    return catalog.select("video_id", F.coalesce("engagement_score", F.lit(0.0)).alias("score"))


def similar_in_category(new_items: DataFrame, catalog: DataFrame, n: int = 20) -> DataFrame:
    """For items without events: the best items of their category.

    Categories are small sets of n ranked rows. The best n + 1 of one travel as an
    array, in order, to its items; an item leaves itself out and takes the first
    n, so no rows are sorted but those of items of several categories. An item
    that is given m times has every place m times, up to n rows.
    """
    order = [F.col("engagement_score").desc_nulls_last(), F.col("video_id")]
    best = top_per_key(catalog, "category", order, n + 1, "place").select(
        "category", "place", F.col("video_id").alias("similar_id"), F.col("engagement_score").alias("score")
    )
    items = new_items.filter(F.col("category").isNotNull() & F.col("video_id").isNotNull()).groupBy("video_id").agg(
        F.min("category").alias("category"), F.max("category").alias("other"), F.count("*").alias("times")
    )
    lists = best.groupBy("category").agg(F.array_sort(F.collect_list(F.struct("place", "similar_id", "score"))).alias("list"))
    others = F.filter("list", lambda item: item["similar_id"] != F.col("video_id"))
    ranks = F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(n).cast("bigint"), F.size("list") * F.col("times")))
    one = (
        items.filter("category = other").join(lists, "category")
        .select("video_id", "category", "times", others.alias("list"))
        .filter(F.size("list") > 0)
        .select("video_id", "category", "times", "list", F.explode(ranks).alias("rank"))
        .withColumn("item", F.element_at("list", F.ceil(F.col("rank") / F.col("times")).cast("int")))
        .select("category", "video_id", "item.similar_id", "item.score", F.col("rank").cast("int").alias("rank"))
    )
    several = new_items.join(items.filter("category <> other").select("video_id"), "video_id", "left_semi")
    pairs = several.select("video_id", "category").join(best.drop("place"), "category").filter(F.col("video_id") != F.col("similar_id"))
    return one.unionByName(top_per_key(pairs, "video_id", [F.col("score").desc_nulls_last(), F.col("similar_id")], n))
