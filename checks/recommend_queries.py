"""Recommenders for all users, serving tiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks.column_queries import METHOD_WEIGHTS, profile_sql, visit_profiles
from checks.inputs import r, t
from checks.registry import ORACLES, query
from checks.table_queries import AFFINITY, BLOCK_LIMIT, QUALITY, preferred, quality
from checks.window_queries import score_sql
from clipsense.operators import items, recommend, serving
from clipsense.operators.recency import recent_video_scores


def _neighbour_sql(tag: str, source: str, alike: str, offered: str, k: int, score: str, n: int = 20) -> str:
    """Bag self-join on the video, top k neighbours, their unseen videos, top n."""
    return f"""{tag}a AS (SELECT user_id, video_id FROM {source} WHERE {alike}),
{tag}n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY common DESC, other) AS k FROM (
  SELECT a.user_id, b.user_id AS other, count(*) AS common FROM {tag}a a JOIN {tag}a b ON a.video_id = b.video_id AND a.user_id <> b.user_id GROUP BY 1, 2)) WHERE k <= {k}),
{tag}c AS (SELECT n.user_id, o.video_id, count(*) AS events, CAST(sum(common) AS DOUBLE) AS common_sum, max(common) AS common_max, avg(o.completion_rate) AS avg_completion
  FROM {tag}n n JOIN {source} o ON o.user_id = n.other AND ({offered})
  WHERE NOT EXISTS (SELECT 1 FROM {source} x WHERE x.user_id = n.user_id AND x.video_id = o.video_id) GROUP BY 1, 2),
{tag}s AS (SELECT user_id, video_id, {score} AS final_score FROM {tag}c JOIN vq USING (video_id)),
{tag}r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY final_score DESC NULLS LAST, video_id) AS rank FROM {tag}s) WHERE rank <= {n})"""


def _likes(source):
    return _neighbour_sql("l", source, "event_type = 'like'", "o.event_type = 'like'", 50,
                          "events * common_sum * 0.7::DOUBLE + quality_score * 0.3::DOUBLE")


def _comments(source):
    return _neighbour_sql("c", source, "event_type = 'comment'", "o.event_type IN ('like', 'comment')", 30,
                          "events * common_max * 0.6::DOUBLE + quality_score * 0.4::DOUBLE")


def _watch(source):
    return _neighbour_sql("w", source, "event_type = 'view' AND completion_rate >= 0.7::DOUBLE", "o.event_type = 'view' AND o.completion_rate >= 0.6::DOUBLE", 40,
                          "events * common_max * 0.5::DOUBLE + avg_completion * 30 + quality_score * 0.3::DOUBLE")


_OUT = f"user_id, video_id, {r('final_score', 'final_score')}, rank"
_Q = f"{I.VISITS}, {QUALITY.format(source='ix')}"


@query("rec_likes", f"WITH {_Q}, {_likes('ix')} SELECT {_OUT} FROM lr")
def rec_likes(spark, sf):
    return recommend.by_likes(I.interactions(spark, sf), quality(spark, sf))


@query("rec_comments", f"WITH {_Q}, {_comments('ix')} SELECT {_OUT} FROM cr")
def rec_comments(spark, sf):
    return recommend.by_comments(I.interactions(spark, sf), quality(spark, sf))


@query("rec_watch", f"WITH {_Q}, {_watch('ix')} SELECT {_OUT} FROM wr")
def rec_watch(spark, sf):
    return recommend.by_watch(I.interactions(spark, sf), quality(spark, sf))


def _union(source):
    return f"""{_likes(source)}, {_comments(source)}, {_watch(source)},
un AS (SELECT user_id, video_id, final_score, 'likes' AS method FROM lr UNION ALL SELECT user_id, video_id, final_score, 'comments' FROM cr
  UNION ALL SELECT user_id, video_id, final_score, 'watch_patterns' FROM wr)"""


@query("union_methods", f"WITH {_Q}, {_union('ix')} SELECT user_id, video_id, {r('final_score', 'final_score')}, method FROM un")
def union_methods(spark, sf):
    ix, q = I.interactions(spark, sf), quality(spark, sf)
    lists = recommend.union_methods(recommend.by_likes(ix, q), recommend.by_comments(ix, q), recommend.by_watch(ix, q))
    return lists.drop("rank")


def _hybrid(source):
    return f"""{profile_sql('vis')}, {QUALITY.format(source='vis')}, {METHOD_WEIGHTS}, {_union(source)},
hs AS (SELECT un.user_id, video_id, sum(final_score * mw.method_weight) AS total_score, string_agg(un.method, '|' ORDER BY un.method) AS methods, count(*) AS method_count
  FROM un LEFT JOIN up USING (user_id) JOIN mw ON mw.user_type = coalesce(up.user_type, 'none') AND mw.method = un.method GROUP BY 1, 2),
hb AS (SELECT *, CASE WHEN method_count >= 3 THEN 10.0::DOUBLE WHEN method_count = 2 THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS diversity_bonus FROM hs),
hr AS (SELECT * FROM (SELECT *, total_score + diversity_bonus AS final_score,
  row_number() OVER (PARTITION BY user_id ORDER BY total_score + diversity_bonus DESC NULLS LAST, video_id) AS rank FROM hb) WHERE rank <= 20)"""


def visit_hybrid(spark, sf):
    rows = I.visits(spark, sf)
    return recommend.hybrid(rows, visit_profiles(spark, sf), items.video_quality(items.video_stats(rows)))


@query("rec_hybrid", f"WITH {_hybrid('vis')} SELECT {_OUT}, {r('total_score', 'total_score')}, {r('diversity_bonus', 'diversity_bonus')}, method_count, methods FROM hr")
def rec_hybrid(spark, sf):
    return visit_hybrid(spark, sf).select(
        "user_id", "video_id", "final_score", "rank", "total_score", "diversity_bonus", "method_count", "methods"
    )


@query("hybrid_aggregate", f"""WITH {_hybrid('vis')} SELECT user_id, video_id, {r('total_score', 'total_score')}, {r('diversity_bonus', 'diversity_bonus')}, method_count, methods FROM hb""")
def hybrid_aggregate(spark, sf):
    rows = I.visits(spark, sf)
    q = items.video_quality(items.video_stats(rows))
    lists = recommend.union_methods(recommend.by_likes(rows, q), recommend.by_comments(rows, q), recommend.by_watch(rows, q))
    scores = recommend.hybrid_scores(recommend.with_method_weights(lists, visit_profiles(spark, sf)))
    return scores.drop("final_score")


@query("rec_all_users", f"WITH {_hybrid('vis')} SELECT user_id, count(*) AS recommendations, {r('max(final_score)', 'best_score')} FROM hr GROUP BY 1")
def rec_all_users(spark, sf):
    return visit_hybrid(spark, sf).groupBy("user_id").agg(F.count("*").alias("recommendations"), F.max("final_score").alias("best_score"))


@query("rec_rows", f"WITH {_hybrid('vis')} SELECT user_id, video_id, {r('final_score', 'score')}, methods, 'hybrid' AS algorithm FROM hr")
def rec_rows(spark, sf):
    rows = recommend.recommendation_rows(visit_hybrid(spark, sf), I.as_of(spark, sf))
    return rows.drop("generated_at")


@query("sink_recommendations", f"""WITH {_Q}, {_likes('ix')} SELECT user_id, video_id, {r('final_score', 'score')}, 'likes' AS algorithm, {t(I.AS_OF, 'generated_at')} FROM lr""")
def sink_recommendations(spark, sf):
    from clipsense.session import scratch_path
    from clipsense.sinks import tables
    from clipsense.sources import files

    path = scratch_path(spark, "recs")
    recs = recommend.by_likes(I.interactions(spark, sf), quality(spark, sf)).withColumn("methods", F.array(F.lit("likes")))
    tables.append(recommend.recommendation_rows(recs, I.as_of(spark, sf), "likes"), path, "recommendations", partition_by=["algorithm"])
    return files.collection(spark, path, "recommendations").drop("methods")


@query("rec_content", f"""WITH {I.VISITS}, {I.CAT}, {AFFINITY},
it AS (SELECT DISTINCT video_id, unnest(string_split(tags, ',')) AS tag FROM cat WHERE tags IS NOT NULL),
sc AS (SELECT pt.user_id, it.video_id, CAST(sum(tag_count) AS BIGINT) AS score FROM pt JOIN it USING (tag) GROUP BY 1, 2),
un AS (SELECT * FROM sc WHERE NOT EXISTS (SELECT 1 FROM vis x WHERE x.user_id = sc.user_id AND x.video_id = sc.video_id))
SELECT user_id, video_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, video_id) AS rank FROM un) WHERE rank <= 20""")
def rec_content(spark, sf):
    return recommend.by_content(preferred(spark, sf), I.visits(spark, sf), I.catalog(spark, sf))


@query("rec_content_groups", ORACLES["rec_content"])
def rec_content_groups(spark, sf):
    """The same with a limit that sends nearly all tags through groups."""
    return recommend.by_content(preferred(spark, sf), I.visits(spark, sf), I.catalog(spark, sf), limit=BLOCK_LIMIT)


_USERS = "us AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer)"


def users(spark, sf):
    """All customers; most of them have no events."""
    return I.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))


_TREND = f"""s20 AS (SELECT video_id, sum(weight) AS score FROM ix WHERE event_time >= {I.AS_OF} - INTERVAL 24 HOURS GROUP BY 1 ORDER BY score DESC, video_id LIMIT 20)"""


@query("rec_serving", f"""WITH {_Q}, {I.CAT}, {score_sql()}, {_comments('ix')}, {_USERS}, {_TREND},
t0 AS (SELECT user_id, video_id, final_score AS score, 'hybrid' AS method, 0 AS tier FROM cr),
al AS (SELECT * FROM t0 UNION ALL SELECT user_id, video_id, score, 'cached', 1 FROM rvs
  UNION ALL SELECT user_id, video_id, score, 'trending', 2 FROM us, s20),
b AS (SELECT user_id, min(tier) AS tier FROM al GROUP BY 1),
p AS (SELECT al.*, row_number() OVER (PARTITION BY user_id ORDER BY score DESC NULLS LAST, video_id) AS rank FROM al JOIN b USING (user_id, tier) JOIN us USING (user_id))
SELECT user_id, video_id, {r('score', 'score')}, method, rank, title FROM p LEFT JOIN cat USING (video_id) WHERE rank <= 20""")
def rec_serving(spark, sf):
    """Users who comment have stored lists, the other users with events cached ones, new users trending videos."""
    from clipsense.operators.catalog import enrich_recommendations

    ix, now = I.interactions(spark, sf), I.as_of(spark, sf)
    stored = recommend.by_comments(ix, quality(spark, sf)).withColumnRenamed("final_score", "score")
    tiers = [("hybrid", stored), ("cached", recent_video_scores(ix, now))]
    shown = serving.first_tier(users(spark, sf), tiers, [("trending", items.trending(ix, now))])
    return enrich_recommendations(shown, I.catalog(spark, sf), ("title",)).select("user_id", "video_id", "score", "method", "rank", "title")


@query("rec_cold_start", f"""WITH {I.IX}, {I.CCAT}, {_TREND}, nw AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT user_id FROM ix)),
ni AS (SELECT video_id AS id, category FROM ccat WHERE video_id NOT IN (SELECT video_id FROM ix)),
a AS (SELECT id, video_id, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, video_id) AS rank FROM nw, s20),
c AS (SELECT video_id, category, engagement_score AS score, row_number() OVER (PARTITION BY category ORDER BY engagement_score DESC NULLS LAST, video_id) AS place FROM ccat),
b AS (SELECT ni.id, c.video_id, score, row_number() OVER (PARTITION BY ni.id ORDER BY score DESC NULLS LAST, c.video_id) AS rank FROM ni JOIN c ON ni.category = c.category AND ni.id <> c.video_id WHERE place <= 21)
SELECT 'user' AS kind, id, video_id, {r('score', 'score')}, rank FROM a UNION ALL SELECT 'video', id, video_id, round(score, 9), rank FROM b WHERE rank <= 20""")
def rec_cold_start(spark, sf):
    ix, now, catalog = I.interactions(spark, sf), I.as_of(spark, sf), I.counted_catalog(spark, sf)
    new_users = users(spark, sf).join(ix.select("user_id").distinct(), "user_id", "left_anti")
    no_rows = ix.select("user_id", "video_id", F.col("weight").alias("score")).filter("false")
    for_users = serving.first_tier(new_users, [("stored", no_rows)], [("trending", items.trending(ix, now))])
    new_items = catalog.join(ix.select("video_id").distinct(), "video_id", "left_anti")
    for_items = serving.similar_in_category(new_items, catalog)
    return for_users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), "video_id", "score", "rank").unionByName(
        for_items.select(F.lit("video").alias("kind"), F.col("video_id").alias("id"), F.col("similar_id").alias("video_id"), "score", "rank")
    )


_QUIET = f"""{I.IX}, {I.CCAT}, {_USERS},
pv AS (SELECT video_id, CAST(count(*) FILTER (event_type = 'view') AS DOUBLE) AS score FROM ix GROUP BY 1),
pc AS (SELECT * FROM pv ORDER BY score DESC, video_id LIMIT 20),
pe AS (SELECT video_id, coalesce(engagement_score, 0) AS score FROM ccat ORDER BY score DESC, video_id LIMIT 20)"""


@query("rec_quiet_day", f"""WITH {_QUIET} SELECT 'views' AS kind, user_id, video_id, {r('score', 'score')}, 'popular' AS method FROM us, pc
UNION ALL SELECT 'no views', user_id, video_id, {r('score', 'score')}, 'engagement' FROM us, pe""")
def rec_quiet_day(spark, sf):
    """A week after the last event nothing trends: the most viewed videos stand in, without views the best engagement scores."""
    ix, catalog = I.interactions(spark, sf), I.counted_catalog(spark, sf)
    later = I.as_of(spark, sf) + F.expr("INTERVAL 7 DAYS")
    own = [("stored", ix.select("user_id", "video_id", F.col("weight").alias("score")).filter("false"))]
    engaging = serving.by_engagement(catalog)

    def shown(events, kind):
        shared = [("trending", items.trending(events, later)), ("popular", serving.by_views(events)), ("engagement", engaging)]
        return serving.first_tier(users(spark, sf), own, shared).select(F.lit(kind).alias("kind"), "user_id", "video_id", "score", "method")

    return shown(ix, "views").unionByName(shown(ix.filter("false"), "no views"))
