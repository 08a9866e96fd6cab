"""Item-item similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsense import fixed_values as V
from clipsense.ml.als import ITEM_BLOCK, Recommender
from clipsense.operators import projections
from clipsense.operators.blocks import arrange, top_products
from clipsense.operators.items import item_user_weights
from clipsense.operators.neighbours import exclude_seen
from clipsense.operators.pairs import HOLDER_LIMIT, similar_pairs, unit_cells
from clipsense.operators.ranking import top_per_key
from clipsense.session import staged


def item_cosine(interactions: DataFrame, threshold: float = V.COSINE_THRESHOLD, limit: int = HOLDER_LIMIT) -> DataFrame:
    """Cosine of the summed weights of two items over all users, from the threshold on."""
    cells = item_user_weights(interactions).select(
        F.col("video_id").alias("entity"), F.col("user_id").alias("feature"), F.col("weight").alias("value")
    )
    return similar_pairs(unit_cells(cells), threshold, limit).select(
        F.col("left").alias("video_id"), F.col("right").alias("similar_id"), F.col("product").alias("cosine")
    )


def item_factor_similarity(recommender: Recommender, k: int = 10, limit: int = ITEM_BLOCK, counts: list[int] | None = None) -> DataFrame:
    """The k items with the closest factors, by cosine; exact.

    Items meet the blocks of ``limit`` like items in falling order of their bounds,
    until no block can hold a closer one. ``counts`` takes how often an item met a block.
    """
    items = staged(recommender.item_vectors())
    return top_products(items, arrange(items, limit, features=recommender.model.rank), k, counts=counts).select(
        F.col("left").alias("video_id"), F.col("right").alias("similar_id"), F.col("product").alias("cosine"), "rank",
    )


def item_factor_projection(recommender: Recommender, k: int = 10, recall: float = 0.95, limit: int = ITEM_BLOCK, told: dict | None = None) -> DataFrame:
    """As ``item_factor_similarity``, from buckets of random projections: exact cosines, nearly all of the nearest.

    ``recall`` is what the setting has to reach on a sample; ``told`` takes the setting.
    """
    items = staged(recommender.item_vectors())
    return projections.nearest(items, recommender.model.rank, k, recall, limit, told).select(
        F.col("left").alias("video_id"), F.col("right").alias("similar_id"), F.col("product").alias("cosine"), "rank",
    )


def by_similar_items(interactions: DataFrame, similar: DataFrame, n: int = 20) -> DataFrame:
    """Unseen items by the user's weights times the similarity to items seen."""
    both = similar.unionByName(
        similar.select(F.col("similar_id").alias("video_id"), F.col("video_id").alias("similar_id"), "cosine")
    )
    scores = (
        item_user_weights(interactions)
        .join(both, "video_id")
        .groupBy("user_id", F.col("similar_id").alias("video_id"))
        .agg(F.sum(F.col("weight") * F.col("cosine")).alias("score"))
    )
    order = [F.col("score").desc(), F.col("video_id")]
    return top_per_key(exclude_seen(scores, interactions), "user_id", order, n)
