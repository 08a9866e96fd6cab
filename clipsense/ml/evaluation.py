"""Ranking metrics over whole recommendation tables."""

from __future__ import annotations

from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipsense.ml.ids import id_index
from clipsense.session import staged


def actual_items(test: DataFrame) -> DataFrame:
    """The distinct videos of each test user, as rows."""
    return test.select("user_id", "video_id").distinct()


def eval_join(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """Predicted rows of users with test rows, each marked as hit or miss."""
    sizes = actual.groupBy("user_id").agg(F.count("*").alias("n_actual"))
    hits = actual.withColumn("hit", F.lit(1))
    return (
        predicted.select("user_id", "video_id", "rank")
        .join(sizes, "user_id")
        .join(hits, ["user_id", "video_id"], "left")
        .withColumn("hit", F.coalesce("hit", F.lit(0)))
    )


def user_metrics(actual: DataFrame, predicted: DataFrame, k: int = 10) -> DataFrame:
    """Precision, recall, average precision and NDCG at k, per user."""
    marked = eval_join(actual, predicted).filter(F.col("rank") <= k)
    so_far = Window.partitionBy("user_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    gain = 1 / F.log2(F.col("rank") + 1)
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.least(F.col("n_actual"), F.lit(k)).cast("int")),
        F.lit(0.0),
        lambda total, place: total + 1 / F.log2(place + 1),
    )
    return (
        marked.withColumn("hits_so_far", F.sum("hit").over(so_far))
        .groupBy("user_id", "n_actual")
        .agg(
            F.sum("hit").alias("hits"),
            F.sum(F.col("hit") * F.col("hits_so_far") / F.col("rank")).alias("gained"),
            F.sum(F.col("hit") * gain).alias("dcg"),
        )
        .select(
            "user_id",
            (F.col("hits") / F.lit(k)).alias("precision"),
            (F.col("hits") / F.col("n_actual")).alias("recall"),
            (F.col("gained") / F.least(F.col("n_actual"), F.lit(k))).alias("average_precision"),
            (F.col("dcg") / ideal).alias("ndcg"),
        )
    )


def ranking_metrics(actual: DataFrame, predicted: DataFrame, k: int = 10) -> DataFrame:
    return user_metrics(actual, predicted, k).agg(
        F.count("*").alias("users"),
        F.avg("precision").alias("precision_at_k"),
        F.avg("recall").alias("recall_at_k"),
        F.avg("average_precision").alias("map_at_k"),
        F.avg("ndcg").alias("ndcg_at_k"),
    )


def metric_lists(actual: DataFrame, predicted: DataFrame, k: int = 10) -> DataFrame:
    """user_id, ``prediction`` and ``label`` as arrays of numbers, the form that the library's evaluator takes. Staged.

    A user's label holds all their videos, as that form asks; ``ranking_metrics``
    keeps them as rows.
    """
    numbers = staged(id_index(actual.select("video_id").unionByName(predicted.select("video_id")), "video_id", "number"))
    number = F.col("number").cast("double")
    ranked = F.array_sort(F.collect_list(F.struct("rank", number.alias("item"))))
    lists = (
        predicted.filter(F.col("rank") <= k).join(numbers, "video_id").groupBy("user_id")
        .agg(F.transform(ranked, lambda x: x["item"]).alias("prediction"))
    )
    labels = actual.join(numbers, "video_id").groupBy("user_id").agg(F.collect_list(number).alias("label"))
    return staged(lists.join(labels, "user_id"))


def evaluator_metrics(actual: DataFrame, predicted: DataFrame, k: int = 10) -> dict[str, float]:
    """The four metrics at k by the library's RankingEvaluator."""
    rows = metric_lists(actual, predicted, k)
    names = {"precisionAtK": "precision_at_k", "recallAtK": "recall_at_k", "meanAveragePrecisionAtK": "map_at_k", "ndcgAtK": "ndcg_at_k"}
    return {ours: RankingEvaluator(metricName=theirs, k=k).evaluate(rows) for theirs, ours in names.items()}
