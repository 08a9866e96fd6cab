"""Implicit-feedback ALS: fit, tune, recommend, save."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALSModel
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsense import fixed_values as V
from clipsense.functions.rules import hash_fraction
from clipsense.ml.factors import FewVideosALS
from clipsense.ml.ids import extended_index, id_index, indexed
from clipsense.operators.blocks import arrange, top_products
from clipsense.operators.serving import first_tier
from clipsense.session import scratch_path, staged

#: Items of a block that a user meets as a whole or not at all.
ITEM_BLOCK = 2_048


def split(df: DataFrame, *keys: str, share: float = V.SPLIT_SHARE, seed: int = V.SEED) -> tuple[DataFrame, DataFrame]:
    """Training and test rows. A hash of the keys decides, so a row that is
    recomputed after a lost executor lands on the same side again."""
    draw = hash_fraction(f"split{seed}", *map(F.col, keys))
    return df.filter(draw < share), df.filter(draw >= share)


class Recommender:
    """An ALS model together with its id tables."""

    def __init__(self, model: ALSModel, users: DataFrame, videos: DataFrame):
        self.model, self.users, self.videos = model, users, videos

    def _lists(self, users: DataFrame, n: int, counts: list[int] | None) -> DataFrame:
        """The n items with the largest scores, for the given rows of user factors.

        Items lie in blocks by the length of their factors and their largest
        ones; a user meets a block only if its bound reaches the user's n-th
        score. Scores have the precision of the factors, and ids break ties.
        """
        rank = self.model.rank
        of = lambda factors: staged(factors.select("id", F.col("features").alias("value")))
        offers = arrange(of(self.model.itemFactors), ITEM_BLOCK, features=rank)
        best = top_products(of(users), offers, n, positive=False, apart=False, single=True, counts=counts)
        rows = best.select(F.col("left").alias("user_idx"), F.col("right").alias("video_idx"), F.col("product").alias("score"), "rank")
        return indexed_back(rows, self.users, self.videos)

    def for_all(self, n: int = 20, counts: list[int] | None = None) -> DataFrame:
        """Top n for every user; ``counts`` takes how often a user met a block in each round."""
        return self._lists(self.model.userFactors, n, counts)

    def for_users(self, users: DataFrame, n: int = 20) -> DataFrame:
        """Top n for the given users that are known to the model."""
        known = users.select("user_id").distinct().join(self.users, "user_id").select(F.col("user_idx").alias("id"))
        return self._lists(self.model.userFactors.join(known, "id"), n, None)

    def predictions(self, rows: DataFrame) -> DataFrame:
        return self.model.transform(indexed(rows, self.users, self.videos))

    def rmse(self, rows: DataFrame, label: str = "weight") -> float:
        """For comparison only: implicit ALS predicts a preference, not a weight."""
        return rmse_evaluator(label).evaluate(self.predictions(rows))

    def item_factors(self) -> DataFrame:
        """(entity, feature, value) cells of the item factors."""
        return (
            self.model.itemFactors.withColumnRenamed("id", "video_idx")
            .join(self.videos, "video_idx")
            .select(F.col("video_id").alias("entity"), F.posexplode("features").alias("feature", "value"))
            .select("entity", F.col("feature").cast("string").alias("feature"), F.col("value").cast("double").alias("value"))
        )

    def item_vectors(self) -> DataFrame:
        """id and value of the items' factors at length one; factors of nothing but zeros are left out."""
        values = F.transform("features", lambda x: x.cast("double"))
        length = F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x))
        return (
            self.model.itemFactors.withColumnRenamed("id", "video_idx")
            .join(self.videos, "video_idx")
            .withColumn("length", length)
            .filter("length > 0")
            .select(
                F.col("video_id").alias("id"), F.transform(values, lambda x: x / F.col("length")).alias("value"),
            )
        )

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/als")
        self.users.write.mode("overwrite").parquet(f"{path}/users")
        self.videos.write.mode("overwrite").parquet(f"{path}/videos")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Recommender:
        return cls(
            ALSModel.load(f"{path}/als"),
            spark.read.parquet(f"{path}/users"),
            spark.read.parquet(f"{path}/videos"),
        )


def indexed_back(rows: DataFrame, users: DataFrame, videos: DataFrame) -> DataFrame:
    return rows.join(users, "user_idx").join(videos, "video_idx").select("user_id", "video_id", "score", "rank")


def rmse_evaluator(label: str) -> RegressionEvaluator:
    return RegressionEvaluator(metricName="rmse", labelCol=label, predictionCol="prediction")


def estimator(label: str = "weight", **settings) -> FewVideosALS:
    return FewVideosALS(
        userCol="user_idx", itemCol="video_idx", ratingCol=label, implicitPrefs=True,
        nonnegative=True, coldStartStrategy="drop", seed=V.SEED, **{**V.ALS_SETTINGS, **settings},
    )


def prepare(rows: DataFrame, label: str = "weight", known: Recommender | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Indexed ratings and both id tables, written once to the shared folder.

    The ids of a ``known`` model stay as they are, new ones are added behind them.

    ALS passes over its input many times, and both the ids and the ratings
    have to be the same in each pass.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "ratings")
    for table, key, name in (("users", "user_id", "user_idx"), ("videos", "video_id", "video_idx")):
        ids = extended_index(getattr(known, table), rows, key, name) if known else id_index(rows, key, name)
        ids.write.parquet(f"{path}/{table}")
    users, videos = spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/videos")
    indexed(rows, users, videos).select("user_idx", "video_idx", label).write.parquet(f"{path}/rows")
    return spark.read.parquet(f"{path}/rows"), users, videos


def train(rows: DataFrame, label: str = "weight", known: Recommender | None = None, **settings) -> Recommender:
    ratings, users, videos = prepare(rows, label, known)
    return Recommender(estimator(label, **settings).fit(ratings), users, videos)


def cross_validate(rows: DataFrame, label: str = "rating", grid: dict | None = None, folds: int = 3, parallelism: int = 4, **settings) -> tuple[CrossValidatorModel, Recommender]:
    """Best model of a parameter grid by RMSE; the default grid has 27 points."""
    ratings, users, videos = prepare(rows, label)
    als = estimator(label, **{**V.ALS_GRID_START, **settings})
    builder = ParamGridBuilder()
    for name, values in (grid or V.ALS_GRID).items():
        builder = builder.addGrid(als.getParam(name), values)
    validator = CrossValidator(
        estimator=als, estimatorParamMaps=builder.build(), evaluator=rmse_evaluator(label),
        numFolds=folds, parallelism=parallelism, seed=V.SEED,
    )
    fitted = validator.fit(ratings)
    return fitted, Recommender(fitted.bestModel, users, videos)


def for_users_or_trending(recommender: Recommender, users: DataFrame, trending: DataFrame, n: int = 20) -> DataFrame:
    """Model rows for known users, the trending list for the others."""
    return first_tier(users, [(V.ALS_METHOD, recommender.for_users(users, n))], [("trending", trending)], n)


def model_metadata(recommender: Recommender, model_type: str, trained_at, version: str) -> DataFrame:
    return recommender.users.agg(F.count("*").alias("users")).select(
        F.lit(model_type).alias("model_type"),
        F.lit(recommender.model.rank).alias("rank"),
        trained_at.alias("trained_at"),
        "users",
        recommender.videos.agg(F.count("*")).scalar().alias("videos"),
        F.lit(version).alias("version"),
    )
