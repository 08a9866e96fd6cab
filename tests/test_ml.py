"""Invariants of the models, and metrics against hand-made results."""

import math
import random

import pytest
from pyspark.sql import functions as F

from clipsense.ml import als, clusters, evaluation, similarity


@pytest.fixture(scope="module")
def rows(spark):
    random.seed(3)
    pairs = {(f"u{random.randrange(30)}", f"v{random.randrange(20)}") for _ in range(250)}
    return spark.createDataFrame([(u, v, float(random.randint(1, 9))) for u, v in sorted(pairs)], "user_id string, video_id string, weight double")


@pytest.fixture(scope="module")
def model(rows):
    return als.train(rows, rank=4, maxIter=3)


def test_lists_are_short_sorted_and_known(rows, model):
    found = model.for_all(5).collect()
    users = {r.user_id for r in rows.collect()}
    videos = {r.video_id for r in rows.collect()}
    assert {r.user_id for r in found} == users and {r.video_id for r in found} <= videos
    for user in users:
        mine = sorted((r for r in found if r.user_id == user), key=lambda r: r["rank"])
        assert len(mine) == 5 and [r.score for r in mine] == sorted((r.score for r in mine), reverse=True)


def test_same_seed_same_lists(rows, model):
    again = als.train(rows, rank=4, maxIter=3)
    a = {(r.user_id, r["rank"]): r.score for r in model.for_all(3).collect()}
    b = {(r.user_id, r["rank"]): r.score for r in again.for_all(3).collect()}
    assert a.keys() == b.keys() and all(math.isclose(a[k], b[k], abs_tol=1e-4) for k in a)


def test_unknown_users_get_the_trending_list(spark, model):
    users = spark.createDataFrame([("u1",), ("nobody",)], "user_id string")
    hot = spark.createDataFrame([("v1", 2.0), ("v2", 1.0)], "video_id string, score double")
    found = als.for_users_or_trending(model, users, hot, 3).collect()
    assert {r.method for r in found if r.user_id == "u1"} == {"distributed_als"}
    assert [(r.video_id, r.method) for r in found if r.user_id == "nobody"] == [("v1", "trending"), ("v2", "trending")]


def test_save_and_load(spark, model, tmp_path):
    model.save(str(tmp_path / "m"))
    loaded = als.Recommender.load(spark, str(tmp_path / "m"))
    assert {tuple(r) for r in loaded.for_all(2).collect()} == {tuple(r) for r in model.for_all(2).collect()}


def test_rmse_is_finite_and_unknown_ids_are_dropped(spark, model, rows):
    odd = rows.unionByName(spark.createDataFrame([("nobody", "v1", 1.0)], rows.schema))
    assert model.predictions(odd).count() == rows.count()
    assert math.isfinite(model.rmse(rows))


def test_split_is_repeatable_and_whole(rows):
    train, test = als.split(rows, "user_id", "video_id")
    assert train.count() + test.count() == rows.count()
    assert {tuple(r) for r in train.collect()} == {tuple(r) for r in als.split(rows.repartition(5), "user_id", "video_id")[0].collect()}


def test_cross_validation_picks_from_the_grid(rows):
    rated = rows.withColumnRenamed("weight", "rating")
    fitted, best = als.cross_validate(rated, grid={"rank": [2, 3]}, folds=2, maxIter=2)
    assert len(fitted.avgMetrics) == 2 and best.model.rank in (2, 3)


def test_factor_similarity_equals_brute_force(model):
    vectors = {}
    for r in model.item_factors().collect():
        vectors.setdefault(r.entity, {})[r.feature] = r.value
    unit = {e: {f: v / math.sqrt(sum(x * x for x in fs.values())) for f, v in fs.items()} for e, fs in vectors.items() if any(fs.values())}
    for limit in (3, 1000):
        for row in similarity.item_factor_similarity(model, k=2, limit=limit).filter("rank = 1").collect():
            mine = unit[row.video_id]
            best = max(sum(mine[f] * o.get(f, 0) for f in mine) for e, o in unit.items() if e != row.video_id)
            assert math.isclose(row.cosine, best, rel_tol=1e-6)


def test_ranking_metrics_by_hand(spark):
    actual = spark.createDataFrame([("u", "a"), ("u", "b"), ("u", "c"), ("lonely", "z")], "user_id string, video_id string")
    predicted = spark.createDataFrame([("u", "a", 1), ("u", "x", 2), ("u", "c", 3), ("u", "b", 4), ("other", "a", 1)], "user_id string, video_id string, rank int")
    row = evaluation.ranking_metrics(actual, predicted, k=3).first()
    ideal = 1 + 1 / math.log2(3) + 1 / math.log2(4)
    assert row.users == 1
    assert row.precision_at_k == pytest.approx(2 / 3) and row.recall_at_k == pytest.approx(2 / 3)
    assert row.map_at_k == pytest.approx((1 + 2 / 3) / 3)
    assert row.ndcg_at_k == pytest.approx((1 + 1 / math.log2(4)) / ideal)


def test_segments_and_scaling(spark):
    random.seed(9)
    shape = "user_id string, total_views long, total_likes long, total_comments long, engagement_rate double, avg_completion_rate double, activity_frequency double"
    people = [(f"u{i}", i % 7 * 10, i % 5, i % 3, random.random(), None if i % 9 == 0 else random.random(), random.random()) for i in range(60)]
    df = spark.createDataFrame(people, shape)
    scaled = clusters.scaled_columns(df)
    for name in scaled.columns[1:]:
        mean, std = scaled.agg(F.avg(name), F.stddev(name)).first()
        assert abs(mean) < 1e-9 and abs(std - 1) < 1e-9
    found = clusters.segments(df).groupBy("segment_no", "user_segment").agg(F.avg(F.col("total_views") + F.col("total_likes") + F.col("total_comments")).alias("a")).orderBy("segment_no").collect()
    assert [r.user_segment for r in found] == ["casual_browsers", "engaged_viewers", "power_users", "new_users", "churned_users"]
    assert [r.a for r in found] == sorted(r.a for r in found)
