"""ALS, segments, similarity, ranking metrics."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import inputs as I
from checks.column_queries import PROFILE, visit_profiles
from checks.inputs import draw, r
from checks.recommend_queries import users
from checks.registry import ORACLES, query
from checks.table_queries import BLOCK_LIMIT
from clipsense.ml import als, clusters, evaluation, similarity
from clipsense.operators import items, recommend
from clipsense.session import scratch_path, staged

# Fitted numbers have no SQL form. The queries below return facts about whole
# fits, with the library's own settings, that SQL can state.
def _gapless():
    return (F.max("rank") == F.count("*")).alias("gapless")


def _listed(recs, n):
    """Per user: rows, and whether ranks have no gap, scores fall and videos differ."""
    falls = F.coalesce(F.lag("score").over(Window.partitionBy("user_id").orderBy("rank")) >= F.col("score"), F.lit(True))
    return recs.withColumn("falls", falls).groupBy("user_id").agg(
        F.count("*").alias("rows"), _gapless(), F.bool_and("falls").alias("falling"),
        (F.count_distinct("video_id") == F.count("*")).alias("different"),
    )


def _listed_sql(n: int) -> str:
    return f"""SELECT user_id, least({n}, (SELECT count(DISTINCT video_id) FROM ix)) AS rows, true AS gapless, true AS falling, true AS different
FROM (SELECT DISTINCT user_id FROM ix)"""


def _rows(spark, sf):
    return I.interactions(spark, sf).select("user_id", "video_id", "weight")


def _split(spark, sf):
    return als.split(I.interactions(spark, sf).select("event_id", "user_id", "video_id", "weight"), "event_id")


@query("train_test_split", f"WITH {I.IX} SELECT event_id, CASE WHEN {draw('split42', 'event_id')} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS side FROM ix")
def train_test_split(spark, sf):
    train, test = _split(spark, sf)
    return train.select("event_id", F.lit("train").alias("side")).unionByName(test.select("event_id", F.lit("test").alias("side")))


@query("als_train", f"""WITH {I.IX}, tr AS (SELECT * FROM ix WHERE {draw('split42', 'event_id')} < 0.8::DOUBLE)
SELECT count(DISTINCT user_id) AS users, count(DISTINCT video_id) AS videos, CAST(64 AS BIGINT) AS least_rank, CAST(64 AS BIGINT) AS most_rank, true AS nonnegative FROM tr""")
def als_train(spark, sf):
    """Size of the fitted factors."""
    model = als.train(_split(spark, sf)[0].drop("event_id")).model
    every = model.userFactors.select("features", F.lit("user").alias("of")).unionByName(model.itemFactors.select("features", F.lit("video").alias("of")))
    size = F.size("features")
    return every.agg(
        F.count_if(F.col("of") == "user").alias("users"), F.count_if(F.col("of") == "video").alias("videos"),
        F.min(size).alias("least_rank"), F.max(size).alias("most_rank"), F.bool_and(F.array_min("features") >= 0).alias("nonnegative"),
    )


@query("als_rmse", f"""WITH {I.IX}, sp AS (SELECT *, {draw('split42', 'event_id')} < 0.8::DOUBLE AS train FROM ix)
SELECT user_id, video_id, count(*) AS rows, true AS from_factors, true AS as_evaluated FROM sp
WHERE NOT train AND user_id IN (SELECT user_id FROM sp WHERE train) AND video_id IN (SELECT video_id FROM sp WHERE train) GROUP BY 1, 2""")
def als_rmse(spark, sf):
    """Every test row has the prediction that its factors give, and the error is that of the stored predictions."""
    train, test = _split(spark, sf)
    model = als.train(train.drop("event_id"))
    stored = staged(model.predictions(test))
    mean = stored.agg(F.avg((F.col("prediction") - F.col("weight")) ** 2)).first()[0]
    as_evaluated = abs(mean**0.5 - model.rmse(test)) < 1e-6
    users = model.model.userFactors.select(F.col("id").alias("user_idx"), F.col("features").alias("own"))
    videos = model.model.itemFactors.select(F.col("id").alias("video_idx"), F.col("features").alias("other"))
    product = F.aggregate(F.zip_with("own", "other", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda total, x: total + x)
    return stored.join(users, "user_idx").join(videos, "video_idx").groupBy("user_id", "video_id").agg(
        F.count("*").alias("rows"), F.bool_and(F.abs(product - F.col("prediction")) < 1e-4).alias("from_factors")
    ).withColumn("as_evaluated", F.lit(as_evaluated))


@query("als_cv", f"WITH {I.IX}, pt AS (SELECT unnest(range(0, 27)) AS point) SELECT point, true AS finite, true AS best_is_least, (SELECT count(DISTINCT user_id) FROM ix WHERE event_type <> 'skip') AS users FROM pt")
def als_cv(spark, sf):
    """All 27 points of the grid in three folds; the chosen model has the least error."""
    rated = items.ratings(I.interactions(spark, sf)).select("user_id", "video_id", "rating")
    fitted, best = als.cross_validate(rated)
    maps, errors = fitted.getEstimatorParamMaps(), fitted.avgMetrics
    least = {p.name: v for p, v in maps[min(range(len(errors)), key=errors.__getitem__)].items()}
    chosen = best.model.rank == least["rank"]
    points = F.array(*[F.struct(F.lit(i).alias("point"), F.lit(0.0 < e < float("inf")).alias("finite")) for i, e in enumerate(errors)])
    return best.users.agg(F.count("*").alias("users")).select("users", F.explode(points).alias("p")).select("p.*", F.lit(chosen).alias("best_is_least"), "users")


@query("als_for_users", f"""WITH {I.IX}, us AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer),
s10 AS (SELECT video_id, sum(weight) AS score FROM ix WHERE event_time >= {I.AS_OF} - INTERVAL 24 HOURS GROUP BY 1 ORDER BY score DESC, video_id LIMIT 10)
SELECT user_id, video_id, {r('score', 'score')}, CAST(1 AS BIGINT) AS rows, 'trending' AS method FROM us, s10 WHERE user_id NOT IN (SELECT user_id FROM ix)
UNION ALL SELECT user_id, NULL, NULL, least(10, (SELECT count(DISTINCT video_id) FROM ix)), 'distributed_als' FROM us WHERE user_id IN (SELECT user_id FROM ix)""")
def als_for_users(spark, sf):
    """Rows of the users the model does not know, and the number of rows of the others."""
    ix = I.interactions(spark, sf)
    model = als.train(_rows(spark, sf))
    shown = als.for_users_or_trending(model, users(spark, sf), items.trending(ix, I.as_of(spark, sf)), 10)
    mine = F.col("method") == "distributed_als"
    return shown.groupBy(
        "user_id", F.when(~mine, F.col("video_id")).alias("video_id"), F.when(~mine, F.col("score")).alias("score"), "method"
    ).agg(F.count("*").alias("rows"))


@query("als_for_all", f"WITH {I.IX} {_listed_sql(20)}")
def als_for_all(spark, sf):
    return _listed(als.train(_rows(spark, sf)).for_all(20), 20)


@query("als_purchases", f"WITH {I.BUY} SELECT count(DISTINCT user_id) * least(20, count(DISTINCT video_id)) AS rows, count(DISTINCT user_id) AS listed_users FROM buy")
def als_purchases(spark, sf):
    """The sparse set with the library's settings: rank 64, 15 iterations."""
    recs = als.train(I.purchases(spark, sf).select("user_id", "video_id", "weight")).for_all(20)
    return recs.agg(F.count("*").alias("rows"), F.count_distinct("user_id").alias("listed_users"))


@query("sink_model", f"WITH {I.IX} SELECT user_id, least(5, (SELECT count(DISTINCT video_id) FROM ix)) AS rows, true AS same FROM (SELECT DISTINCT user_id FROM ix)")
def sink_model(spark, sf):
    """Save, load, and recommend with what was loaded: the lists of the model that was saved."""
    path = scratch_path(spark, "model")
    model = als.train(_rows(spark, sf))
    model.save(path)
    loaded = als.Recommender.load(spark, path).for_all(5).withColumnRenamed("score", "loaded")
    both = model.for_all(5).join(loaded, ["user_id", "video_id", "rank"], "full")
    return both.groupBy("user_id").agg(F.count("*").alias("rows"), F.bool_and(F.coalesce(F.col("score") == F.col("loaded"), F.lit(False))).alias("same"))


@query("model_metadata", f"""WITH {I.IX} SELECT 'als' AS model_type, CAST(64 AS BIGINT) AS rank, count(DISTINCT user_id) AS users, count(DISTINCT video_id) AS videos, '1' AS version FROM ix""")
def model_metadata(spark, sf):
    model = als.train(_rows(spark, sf))
    return als.model_metadata(model, "als", F.current_timestamp(), "1").drop("trained_at")


_EVAL = f"""{I.IX}, sp AS (SELECT *, {draw('split42', 'event_id')} < 0.8::DOUBLE AS train FROM ix),
ac AS (SELECT DISTINCT user_id, video_id FROM sp WHERE NOT train),
pop AS (SELECT video_id, count(*) AS n FROM sp WHERE train GROUP BY 1),
us AS (SELECT DISTINCT user_id FROM ac),
pd AS (SELECT * FROM (SELECT user_id, video_id, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, video_id) AS rank FROM us, pop) WHERE rank <= 10),
na AS (SELECT user_id, count(*) AS n_actual FROM ac GROUP BY 1),
mk AS (SELECT pd.*, n_actual, CASE WHEN ac.video_id IS NULL THEN 0 ELSE 1 END AS hit FROM pd JOIN na USING (user_id) LEFT JOIN ac USING (user_id, video_id)),
hs AS (SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY rank) AS so_far FROM mk),
um AS (SELECT user_id, sum(hit) / 10.0::DOUBLE AS p, sum(hit) / n_actual::DOUBLE AS rc, sum(hit * so_far / rank::DOUBLE) / least(n_actual, 10) AS ap,
  sum(hit / log2(rank + 1)) / list_sum(list_transform(range(1, least(n_actual, 10) + 1), lambda i: 1 / log2(i + 1))) AS nd FROM hs GROUP BY user_id, n_actual)"""


_METRICS = """WITH sizes AS (SELECT user_id, count(*) AS n_actual FROM {actual} GROUP BY user_id),
marked AS (SELECT p.user_id, p.rank, s.n_actual, CASE WHEN a.video_id IS NULL THEN 0 ELSE 1 END AS hit FROM {predicted} p JOIN sizes s ON p.user_id = s.user_id
  LEFT JOIN {actual} a ON p.user_id = a.user_id AND p.video_id = a.video_id WHERE p.rank <= 10),
running AS (SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY rank) AS so_far FROM marked),
ideal AS (SELECT n, (SELECT sum(1 / log2(i + 1)) FROM (SELECT explode(sequence(1, 10)) AS i) WHERE i <= n) AS best FROM (SELECT explode(sequence(1, 10)) AS n)),
by_user AS (SELECT user_id, sum(hit) / 10D AS p, sum(hit) / CAST(n_actual AS DOUBLE) AS r, sum(hit * so_far / CAST(rank AS DOUBLE)) / least(n_actual, 10) AS a,
  sum(hit / log2(rank + 1)) AS gain, least(n_actual, 10) AS n FROM running GROUP BY user_id, n_actual)
SELECT count(*) AS users, avg(p) AS precision_at_k, avg(r) AS recall_at_k, avg(a) AS map_at_k, avg(gain / best) AS ndcg_at_k FROM by_user JOIN ideal USING (n)"""


def _als_for_test_users(spark, sf):
    train, test = _split(spark, sf)
    actual = staged(evaluation.actual_items(test))
    model = als.train(train.drop("event_id"))
    return actual, staged(model.for_users(actual.select("user_id").distinct(), 10))


@query("ranking_eval_als", f"""WITH {I.IX}, sp AS (SELECT *, {draw('split42', 'event_id')} < 0.8::DOUBLE AS train FROM ix)
SELECT metric, (SELECT count(DISTINCT user_id) FROM sp WHERE NOT train AND user_id IN (SELECT user_id FROM sp WHERE train)) AS users, true AS recomputed, true AS as_evaluator
FROM (SELECT unnest(['precision_at_k', 'recall_at_k', 'map_at_k', 'ndcg_at_k']) AS metric)""")
def ranking_eval_als(spark, sf):
    """The metrics of the model's lists for all test users it knows: those recomputed in SQL from the
    stored lists, and those of the library's evaluator."""
    actual, predicted = _als_for_test_users(spark, sf)
    ours = evaluation.ranking_metrics(actual, predicted).first()
    again = spark.sql(_METRICS, actual=actual, predicted=predicted).first()
    theirs = evaluation.evaluator_metrics(actual, predicted)
    rows = [(name, ours["users"], again["users"] == ours["users"] and abs(again[name] - ours[name]) < 1e-9, abs(theirs[name] - ours[name]) < 1e-9) for name in theirs]
    return spark.createDataFrame(rows, "metric string, users bigint, recomputed boolean, as_evaluator boolean")


def _popular_for_test_users(spark, sf):
    """The most frequent training videos, for every test user."""
    from clipsense.operators.serving import first_tier

    train, test = _split(spark, sf)
    popular = train.groupBy("video_id").agg(F.count("*").cast("double").alias("score"))
    actual = evaluation.actual_items(test)
    none = train.select("user_id", "video_id", F.col("weight").alias("score")).filter("false")
    return actual, first_tier(actual.select("user_id").distinct(), [("own", none)], [("popular", popular)], 10)


@query("ranking_eval", f"WITH {_EVAL} SELECT count(*) AS users, {r('avg(p)', 'precision_at_k')}, {r('avg(rc)', 'recall_at_k')}, {r('avg(ap)', 'map_at_k')}, {r('avg(nd)', 'ndcg_at_k')} FROM um")
def ranking_eval(spark, sf):
    return evaluation.ranking_metrics(*_popular_for_test_users(spark, sf))


@query("eval_join", f"WITH {_EVAL} SELECT user_id, video_id, rank, n_actual, hit FROM mk")
def eval_join(spark, sf):
    return evaluation.eval_join(*_popular_for_test_users(spark, sf))


@query("actual_items", f"WITH {_EVAL} SELECT user_id, video_id FROM ac")
def actual_items(spark, sf):
    return evaluation.actual_items(_split(spark, sf)[1])


_FEATURES = ("total_views", "total_likes", "total_comments", "engagement_rate", "avg_completion_rate", "activity_frequency")
_SCALED = ", ".join(r(f"({f} - avg({f}) OVER ()) / stddev_samp({f}) OVER ()", f"scaled_{f}") for f in _FEATURES)


@query("cluster_features", f"""WITH {PROFILE}, ff AS (SELECT user_id, total_views, total_likes, total_comments, engagement_rate,
  coalesce(avg_completion_rate, 0) AS avg_completion_rate, activity_frequency FROM up) SELECT user_id, {_SCALED} FROM ff""")
def cluster_features(spark, sf):
    return clusters.scaled_columns(visit_profiles(spark, sf))


@query("user_clusters", f"WITH {PROFILE} SELECT count(*) AS users, CAST(5 AS BIGINT) AS segments, true AS nearest, true AS in_order, true AS named FROM up")
def user_clusters(spark, sf):
    """Every user is at the nearest centre, and segments are numbered by mean activity."""
    model, filled = clusters.fit(visit_profiles(spark, sf))
    found = clusters.named(model, filled)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.stages[-1].clusterCenters()])
    here = vector_to_array("scaled_features")
    distances = F.transform(centres, lambda c: F.aggregate(F.zip_with(c, here, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    near = F.element_at(distances, F.col("prediction") + 1) <= F.array_min(distances) + 1e-9
    sizes = found.withColumn("near", near).groupBy("segment_no").agg(
        F.count("*").alias("n"), F.bool_and("near").alias("near"), F.count_distinct("user_segment").alias("names"),
        F.avg(F.col("total_views") + F.col("total_likes") + F.col("total_comments")).alias("activity"),
    )
    by_number = sizes.withColumn("rises", F.coalesce(F.lag("activity").over(Window.orderBy("segment_no")) <= F.col("activity"), F.lit(True)))
    return by_number.agg(
        F.sum("n").alias("users"), F.count("*").alias("segments"), F.bool_and("near").alias("nearest"),
        F.bool_and("rises").alias("in_order"), F.bool_and(F.col("names") == 1).alias("named"),
    )


def _cosine(source: str, threshold: float = 0.3) -> str:
    return f"""w AS (SELECT video_id, user_id, sum(weight) AS weight FROM {source} GROUP BY 1, 2),
n AS (SELECT video_id, sqrt(sum(weight * weight)) AS norm FROM w GROUP BY 1),
d AS (SELECT a.video_id, b.video_id AS similar_id, sum(a.weight * b.weight) AS dot FROM w a JOIN w b ON a.user_id = b.user_id AND a.video_id < b.video_id GROUP BY 1, 2),
co AS (SELECT d.video_id, similar_id, dot / (x.norm * y.norm) AS cosine FROM d JOIN n x ON x.video_id = d.video_id JOIN n y ON y.video_id = d.similar_id)
SELECT video_id, similar_id, {r('cosine', 'cosine')} FROM co WHERE cosine >= {threshold}::DOUBLE"""


@query("item_cosine", f"WITH {I.IX}, {_cosine('ix')}")
def item_cosine(spark, sf):
    return similarity.item_cosine(I.interactions(spark, sf))


@query("item_cosine_sparse", f"WITH {I.BUY}, {_cosine('buy', 0.15)}")
def item_cosine_sparse(spark, sf):
    """Parts are seldom bought together: no pair reaches the default of 0.3."""
    return similarity.item_cosine(I.purchases(spark, sf), threshold=0.15)


@query("item_cosine_blocks", ORACLES["item_cosine"])
def item_cosine_blocks(spark, sf):
    """The same with a limit that sends nearly all users through blocks."""
    return similarity.item_cosine(I.interactions(spark, sf), limit=BLOCK_LIMIT)


@query("item_cosine_sparse_blocks", ORACLES["item_cosine_sparse"])
def item_cosine_sparse_blocks(spark, sf):
    return similarity.item_cosine(I.purchases(spark, sf), threshold=0.15, limit=BLOCK_LIMIT)


def _nearest(spark, model, found):
    """Of each video: rows, gaps, whether the cosines are those of the factors, and how many of all others are nearer than the last."""
    vectors = staged(model.item_vectors())
    dot = F.aggregate(F.zip_with("value", "others", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    lasts = found.groupBy("video_id").agg(F.min("cosine").alias("last"), F.count("*").alias("rows"), _gapless())
    # The check itself looks at every video against every block of all others, one array a block.
    blocks = vectors.groupBy(F.pmod(F.xxhash64("id"), F.lit(64)).alias("block")).agg(F.collect_list(F.struct("id", F.col("value").alias("others"))).alias("block_rows"))
    told = lasts.join(vectors, F.col("id") == F.col("video_id")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(63)).cast("array<bigint>")))
    cosine = lambda row: F.aggregate(F.zip_with("value", row["others"], lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    nearer = F.size(F.filter("block_rows", lambda row: (row["id"] != F.col("video_id")) & (cosine(row) > F.col("last") + 1e-9)))
    counts = told.join(blocks, "block").groupBy("video_id", "rows", "gapless").agg(F.sum(nearer).alias("nearer"))
    shown = found.join(vectors.withColumnRenamed("id", "video_id"), "video_id").join(
        vectors.select(F.col("id").alias("similar_id"), F.col("value").alias("others")), "similar_id"
    )
    exact = shown.groupBy("video_id").agg(F.bool_and(F.abs(dot - F.col("cosine")) < 1e-9).alias("exact"))
    return counts.join(exact, "video_id")


@query("item_factor_similarity", f"WITH {I.IX}, v AS (SELECT DISTINCT video_id FROM ix) SELECT video_id, least(10, (SELECT count(*) - 1 FROM v)) AS rows, true AS gapless, true AS exact, true AS nearest FROM v")
def item_factor_similarity(spark, sf):
    """The ten nearest of each video; their cosines are those of the factors, and no other video is nearer than the last."""
    model = als.train(_rows(spark, sf))
    told = _nearest(spark, model, staged(similarity.item_factor_similarity(model)))
    return told.select("video_id", "rows", "gapless", "exact", (F.col("nearer") <= F.col("rows") - 1).alias("nearest"))


@query("item_factor_projection", f"WITH {I.IX}, v AS (SELECT DISTINCT video_id FROM ix) SELECT count(*) AS videos, true AS gapless, true AS exact, true AS recalled FROM v")
def item_factor_projection(spark, sf):
    """The nearest by random projections: their cosines are exact, and at least nine of ten are the nearest of all."""
    model = als.train(_rows(spark, sf))
    found = staged(similarity.item_factor_projection(model))
    every = staged(similarity.item_factor_similarity(model))
    told = _nearest(spark, model, found)
    last = every.groupBy("video_id").agg(F.min("cosine").alias("last"), F.count("*").alias("wanted"))
    hits = last.join(found, "video_id", "left").groupBy("video_id", "wanted").agg(F.count_if(F.col("cosine") >= F.col("last") - 1e-9).alias("hits"))
    recall = hits.agg(F.sum(F.least("hits", "wanted")) / F.sum("wanted")).first()[0]
    return told.agg(F.count("*").alias("videos"), F.bool_and("gapless").alias("gapless"), F.bool_and("exact").alias("exact")).withColumn("recalled", F.lit(recall >= 0.9))


@query("rec_als_itemcf", f"WITH {I.IX} SELECT user_id, least(20, (SELECT count(DISTINCT video_id) FROM ix)) AS rows, true AS gapless, true AS falling, true AS different, true AS exact FROM (SELECT DISTINCT user_id FROM ix)")
def rec_als_itemcf(spark, sf):
    """The mixed lists, and whether their scores are those of the two lists they were mixed from."""
    ix = I.interactions(spark, sf)
    parts = {
        "als": staged(als.train(_rows(spark, sf)).for_all(20)),
        "item_cf": staged(similarity.by_similar_items(ix, similarity.item_cosine(ix))),
    }
    mixed = staged(recommend.mixed({name: (recs, 0.5) for name, recs in parts.items()}))
    again = None
    for recs in parts.values():
        ends = recs.groupBy("user_id").agg(F.min("score").alias("low"), F.max("score").alias("high"))
        unit = F.when(F.col("high") > F.col("low"), (F.col("score") - F.col("low")) / (F.col("high") - F.col("low"))).otherwise(1.0)
        part = recs.join(ends, "user_id").select("user_id", "video_id", (unit * 0.5).alias("expected"))
        again = part if again is None else again.unionByName(part)
    sums = again.groupBy("user_id", "video_id").agg(F.sum("expected").alias("expected"))
    exact = mixed.join(sums, ["user_id", "video_id"]).groupBy("user_id").agg(
        F.bool_and(F.abs(F.col("score") - F.col("expected")) < 1e-9).alias("exact")
    )
    return _listed(mixed, 20).join(exact, "user_id")
