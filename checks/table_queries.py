"""Joins, aggregations, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks.column_queries import PROFILE, profile_sql, visit_profiles
from checks.inputs import draw, r, t
from checks.registry import ORACLES, query
from clipsense import fixed_values as V
from clipsense.functions.rules import hash_fraction
from clipsense.ml.ids import extended_index, id_index
from clipsense.operators import catalog as cat
from clipsense.operators import items, loading, neighbours, profiles
from clipsense.operators.recency import interaction_counter, recent_interactions, video_counters
from clipsense.session import staged

#: Holders of a feature beyond which the second entry of a pair query takes blocks.
BLOCK_LIMIT = 8

# ------------------------------------------------------------------ joins


@query("catalog_join", f"""WITH {I.IX}, {I.CCAT}, ids AS (SELECT DISTINCT video_id FROM ix)
SELECT video_id, title, likes, views, tags FROM ids LEFT JOIN ccat USING (video_id)""")
def catalog_join(spark, sf):
    known = I.catalog(spark, sf)
    return cat.catalog_join(
        I.interactions(spark, sf), known.select("video_id", "title"), I.likes_views(spark, sf), known.select("video_id", "tags")
    )


@query("enrich_interactions", f"WITH {I.IX}, {I.CAT} SELECT event_id, user_id, title, category FROM ix LEFT JOIN cat USING (video_id)")
def enrich_interactions(spark, sf):
    return cat.enrich_interactions(I.interactions(spark, sf), I.catalog(spark, sf)).select("event_id", "user_id", "title", "category")


@query("interactions_with_tags", f"WITH {I.IX}, {I.CAT} SELECT event_id, tags FROM ix JOIN cat USING (video_id)")
def interactions_with_tags(spark, sf):
    return cat.interactions_with_tags(I.interactions(spark, sf), I.catalog(spark, sf)).select("event_id", "tags")


@query("neighbour_join", f"""WITH {I.IX}, k AS (SELECT user_id, video_id FROM ix WHERE event_type = 'like')
SELECT a.user_id, b.user_id AS neighbour_id, count(*) AS common FROM k a JOIN k b ON a.video_id = b.video_id AND a.user_id <> b.user_id GROUP BY 1, 2""")
def neighbour_join(spark, sf):
    return neighbours.common_counts(I.interactions(spark, sf).filter(F.col("event_type") == "like"))


@query("neighbour_join_blocks", ORACLES["neighbour_join"])
def neighbour_join_blocks(spark, sf):
    """The same with a limit that sends nearly all videos through blocks."""
    return neighbours.common_counts(I.interactions(spark, sf).filter(F.col("event_type") == "like"), limit=BLOCK_LIMIT)


@query("exclude_seen", f"""WITH {I.IX}, likes AS (SELECT DISTINCT event_type, video_id FROM ix), us AS (SELECT DISTINCT user_id, event_type FROM ix)
SELECT DISTINCT us.user_id, likes.video_id FROM us JOIN likes USING (event_type)
WHERE NOT EXISTS (SELECT 1 FROM ix WHERE ix.user_id = us.user_id AND ix.video_id = likes.video_id)""")
def exclude_seen(spark, sf):
    ix = I.interactions(spark, sf)
    pairs = ix.select("user_id", "event_type").distinct().join(ix.select("event_type", "video_id").distinct(), "event_type")
    return neighbours.exclude_seen(pairs.select("user_id", "video_id").distinct(), ix)


_COMMON = f"""{I.IX}, k AS (SELECT user_id, video_id FROM ix WHERE event_type = 'like'),
nb0 AS (SELECT a.user_id, b.user_id AS neighbour_id, count(*) AS common FROM k a JOIN k b ON a.video_id = b.video_id AND a.user_id <> b.user_id GROUP BY 1, 2),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY common DESC, neighbour_id) AS rank FROM nb0) WHERE rank <= 50),
cd AS (SELECT nb.user_id, k.video_id, count(*) AS events, CAST(sum(common) AS BIGINT) AS common_sum, max(common) AS common_max
  FROM nb JOIN k ON k.user_id = nb.neighbour_id GROUP BY 1, 2)"""


@query("top_neighbours", f"WITH {_COMMON} SELECT user_id, neighbour_id, common, rank FROM nb")
def top_neighbours(spark, sf):
    return neighbours.top_neighbours(I.interactions(spark, sf).filter(F.col("event_type") == "like"), 50)


@query("top_neighbours_blocks", ORACLES["top_neighbours"])
def top_neighbours_blocks(spark, sf):
    return neighbours.top_neighbours(I.interactions(spark, sf).filter(F.col("event_type") == "like"), 50, limit=BLOCK_LIMIT)


@query("candidate_join", f"WITH {_COMMON} SELECT user_id, video_id, events, common_sum, common_max FROM cd")
def candidate_join(spark, sf):
    likes = I.interactions(spark, sf).filter(F.col("event_type") == "like")
    return neighbours.candidates(neighbours.top_neighbours(likes, 50), likes).drop("avg_completion")


QUALITY = """vs AS (SELECT video_id, count(*) FILTER (event_type = 'view') AS view_count, count(*) FILTER (event_type = 'like') AS like_count,
    count(*) FILTER (event_type = 'comment') AS comment_count, count(*) FILTER (event_type = 'share') AS share_count,
    avg(completion_rate) FILTER (event_type = 'view') AS avg_completion_rate, count(DISTINCT user_id) AS unique_viewers FROM {source} GROUP BY 1),
vq0 AS (SELECT *, (like_count * 2.0::DOUBLE + comment_count * 3.0::DOUBLE + share_count * 4.0::DOUBLE) / (view_count + 1) AS engagement_score FROM vs),
vq AS (SELECT *, avg_completion_rate * 50.0::DOUBLE + engagement_score * 30.0::DOUBLE + ln(1 + unique_viewers) * 10.0::DOUBLE AS quality_score FROM vq0)"""


def quality(spark, sf):
    return items.video_quality(items.video_stats(I.interactions(spark, sf)))


@query("attach_video_stats", f"""WITH {I.IX}, {QUALITY.format(source='ix')}, p AS (SELECT DISTINCT user_id, video_id FROM ix)
SELECT user_id, video_id, {r('quality_score', 'quality_score')} FROM p JOIN vq USING (video_id)""")
def attach_video_stats(spark, sf):
    return neighbours.attach_video_stats(I.interactions(spark, sf).select("user_id", "video_id").distinct(), quality(spark, sf))


AFFINITY = """ta AS (SELECT user_id, tags, count(*) AS view_count, avg(watch_time) AS avg_watch_time, avg(completion_rate) AS avg_completion_rate,
    count(*) * avg(completion_rate) * 100 AS tags_score FROM vis JOIN cat USING (video_id) GROUP BY 1, 2),
tt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY tags_score DESC NULLS LAST, tags) AS rank FROM ta) WHERE rank <= 5),
tc AS (SELECT user_id, tag, count(*) AS tag_count FROM (SELECT user_id, unnest(string_split(tags, ',')) AS tag FROM vis JOIN cat USING (video_id)) GROUP BY 1, 2),
pt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY tag_count DESC, tag) AS rank FROM tc) WHERE rank <= 10)"""


def ranked_tags(spark, sf):
    return profiles.top_tags(profiles.tag_affinity(I.visits(spark, sf), I.catalog(spark, sf)))


def preferred(spark, sf):
    return profiles.preferred_tags(profiles.tag_counts(I.visits(spark, sf), I.catalog(spark, sf)))


@query("full_profiles", f"""WITH {PROFILE}, {AFFINITY},
a AS (SELECT user_id, string_agg(tags, '|' ORDER BY rank) AS top_categories FROM tt GROUP BY 1),
b AS (SELECT user_id, string_agg(tag, '|' ORDER BY rank) AS preferred_tags FROM pt GROUP BY 1)
SELECT user_id, {r('user_score', 'user_score')}, user_type, top_categories, preferred_tags FROM up LEFT JOIN a USING (user_id) LEFT JOIN b USING (user_id)""")
def full_profiles(spark, sf):
    full = profiles.full_profiles(visit_profiles(spark, sf), ranked_tags(spark, sf), preferred(spark, sf))
    return full.select(
        "user_id", "user_score", "user_type",
        F.col("top_categories.tags").alias("top_categories"), F.col("preferred_tags.tag").alias("preferred_tags"),
    )


@query("enrich_recs", f"""WITH {I.IX}, {I.CCAT}, s AS (SELECT user_id, video_id, sum(weight) AS score FROM ix GROUP BY 1, 2)
SELECT user_id, video_id, {r('score', 'score')}, title, tags, views, likes FROM s LEFT JOIN ccat USING (video_id)""")
def enrich_recs(spark, sf):
    recs = I.interactions(spark, sf).groupBy("user_id", "video_id").agg(F.sum("weight").alias("score"))
    return cat.enrich_recommendations(recs, I.counted_catalog(spark, sf))


@query("profile_view", f"""WITH {profile_sql('vis')}, {AFFINITY},
a AS (SELECT user_id, string_agg(tags, '|' ORDER BY rank) AS favorite_categories FROM tt GROUP BY 1),
e AS (SELECT user_id, string_agg(video_id, '|' ORDER BY event_time DESC, video_id, event_type) AS recent FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, video_id, event_type) AS rank FROM vis) WHERE rank <= 100 GROUP BY 1)
SELECT user_id, total_views + total_likes + total_comments + total_shares AS acts, favorite_categories, recent
FROM up LEFT JOIN a USING (user_id) LEFT JOIN e USING (user_id)""")
def profile_view(spark, sf):
    rows = profiles.profile_view(visit_profiles(spark, sf), ranked_tags(spark, sf), recent_interactions(I.visits(spark, sf)))
    return rows.select(
        "user_id", (F.col("total_views") + F.col("total_likes") + F.col("total_comments") + F.col("total_shares")).alias("acts"),
        F.col("favorite_categories.tags").alias("favorite_categories"), F.col("recent_interactions.video_id").alias("recent"),
    )


@query("id_index", f"""WITH {I.IX}, k AS (SELECT 'user' AS kind, user_id AS id FROM ix UNION SELECT 'video', video_id FROM ix)
SELECT kind, id, row_number() OVER (PARTITION BY kind ORDER BY substr(md5(id), 1, 3), id) - 1 AS idx FROM k""")
def id_index_query(spark, sf):
    ix = I.interactions(spark, sf)
    parts = [
        id_index(ix, f"{kind}_id", "idx").select(F.lit(kind).alias("kind"), F.col(f"{kind}_id").alias("id"), "idx")
        for kind in ("user", "video")
    ]
    return parts[0].unionByName(parts[1])


@query("id_index_grown", f"""WITH {I.IX}, k AS (SELECT user_id, bool_or({draw('first', 'event_id')} < 0.1::DOUBLE) AS known FROM ix GROUP BY 1),
n AS (SELECT count(*) FILTER (known) AS n_known, count(*) AS n_all FROM k)
SELECT user_id, known, true AS placed, n_all AS ids, n_all - 1 AS last FROM k, n""")
def id_index_grown(spark, sf):
    """A tenth of the events comes first, then all: ids of the first load are kept, new ones follow without a gap."""
    ix = I.interactions(spark, sf)
    first = staged(id_index(ix.filter(hash_fraction("first", F.col("event_id")) < 0.1), "user_id", "idx"))
    grown = staged(extended_index(first, ix, "user_id", "idx"))
    before = first.withColumnRenamed("idx", "was")
    n_known = first.count()
    ends = grown.agg(F.count_distinct("idx").alias("ids"), F.max("idx").alias("last")).first()
    placed = F.coalesce(F.col("idx") == F.col("was"), F.col("idx") >= n_known)
    return grown.join(before, "user_id", "left").select(
        "user_id", F.col("was").isNotNull().alias("known"), placed.alias("placed"), F.lit(ends["ids"]).alias("ids"), F.lit(ends["last"]).alias("last")
    )


# ----------------------------------------------------------- aggregations

_STATS = "video_id, view_count, like_count, comment_count, share_count"


@query("video_stats", f"""WITH {I.IX}, {QUALITY.format(source='ix')} SELECT {_STATS}, {r('avg_completion_rate', 'avg_completion_rate')}, unique_viewers FROM vs""")
def video_stats(spark, sf):
    return items.video_stats(I.interactions(spark, sf))


@query("video_quality", f"""WITH {I.IX}, {QUALITY.format(source='ix')} SELECT {_STATS}, {r('avg_completion_rate', 'avg_completion_rate')}, unique_viewers,
  {r('engagement_score', 'engagement_score')}, {r('quality_score', 'quality_score')} FROM vq""")
def video_quality(spark, sf):
    return quality(spark, sf)


_COUNTS = "user_id, total_views, total_likes, total_comments, total_shares, total_collects, unique_videos_watched, unique_categories"


@query("user_profile", f"""WITH {profile_sql('ix')} SELECT {_COUNTS}, {r('avg_watch_time', 'avg_watch_time')}, {r('avg_completion_rate', 'avg_completion_rate')},
  {t('first_interaction', 'first_interaction')}, {t('last_interaction', 'last_interaction')} FROM up""")
def user_profile(spark, sf):
    return profiles.user_profile(I.interactions(spark, sf), I.catalog(spark, sf))


@query("watched_tags", f"WITH {I.IX}, {I.CAT} SELECT user_id, tags, count(*) AS times FROM ix JOIN cat USING (video_id) WHERE tags IS NOT NULL GROUP BY 1, 2")
def watched_tags(spark, sf):
    return profiles.watched_tags(I.interactions(spark, sf), I.catalog(spark, sf))


@query("profile_derived", f"""WITH {profile_sql('ix')} SELECT user_id, {r('engagement_rate', 'engagement_rate')}, active_days, {r('activity_frequency', 'activity_frequency')} FROM up""")
def profile_derived(spark, sf):
    full = profiles.derived(profiles.user_profile(I.interactions(spark, sf), I.catalog(spark, sf)))
    return full.select("user_id", "engagement_rate", "active_days", "activity_frequency")


@query("user_score", f"""WITH {PROFILE} SELECT user_id, {r('user_score', 'user_score')},
  {r('CASE WHEN avg_completion_rate IS NULL THEN 100 ELSE user_score END', 'old_score')} FROM up""")
def user_score(spark, sf):
    from clipsense.functions.users import user_score as score

    return visit_profiles(spark, sf).select("user_id", "user_score", score(null_as_max=True).alias("old_score"))


@query("tag_affinity", f"""WITH {I.VISITS}, {I.CAT}, {AFFINITY} SELECT user_id, tags, view_count, {r('avg_watch_time', 'avg_watch_time')},
  {r('avg_completion_rate', 'avg_completion_rate')}, {r('tags_score', 'tags_score')} FROM ta""")
def tag_affinity(spark, sf):
    return profiles.tag_affinity(I.visits(spark, sf), I.catalog(spark, sf))


@query("tag_counts", f"WITH {I.VISITS}, {I.CAT}, {AFFINITY} SELECT user_id, tag, tag_count FROM tc")
def tag_counts(spark, sf):
    return profiles.tag_counts(I.visits(spark, sf), I.catalog(spark, sf))


@query("profile_insights", f"""WITH {PROFILE}, o AS (SELECT avg(user_score) AS s, avg(engagement_rate) AS e, avg(total_views) AS v, count(*) AS n FROM up),
k AS (SELECT user_type, count(*) AS users FROM up GROUP BY 1)
SELECT user_type, users, {r('s', 'avg_user_score')}, {r('e', 'avg_engagement_rate')}, {r('v', 'avg_views_per_user')}, n AS total_users FROM k, o""")
def profile_insights(spark, sf):
    return profiles.insights(visit_profiles(spark, sf))


_RATINGS = f"{I.IX}, rt AS (SELECT user_id, video_id, CAST(count(*) AS DOUBLE) AS rating, avg(epoch_us(event_time) / 1000.0::DOUBLE) AS ts FROM ix GROUP BY 1, 2)"


@query("ratings", f"WITH {_RATINGS} SELECT user_id, video_id, rating, CAST(round(ts) AS BIGINT) AS timestamp FROM rt")
def ratings(spark, sf):
    return items.ratings(I.interactions(spark, sf)).withColumn("timestamp", F.round("timestamp").cast("bigint"))


@query("rating_distribution", f"""WITH {_RATINGS} SELECT count(rating) AS count, {r('avg(rating)', 'mean')}, {r('stddev_samp(rating)', 'stddev')},
  min(rating) AS min, max(rating) AS max FROM rt""")
def rating_distribution(spark, sf):
    return items.rating_distribution(items.ratings(I.interactions(spark, sf)))


@query("event_breakdown", f"WITH {I.IX} SELECT event_type, count(*) AS events FROM ix GROUP BY 1")
def event_breakdown(spark, sf):
    return items.event_breakdown(I.interactions(spark, sf))


@query("dataset_summary", f"""WITH {I.IX} SELECT count(*) AS total_interactions, count(DISTINCT user_id) AS unique_users, count(DISTINCT video_id) AS unique_videos,
  {r("count(*) FILTER (event_type = 'view') / (SELECT count(*) FROM part)::DOUBLE", 'avg_views_per_video')},
  {r("count(*) FILTER (event_type = 'like') / (SELECT count(*) FROM part)::DOUBLE", 'avg_likes_per_video')}, (SELECT count(*) FROM part) AS total_videos FROM ix""")
def dataset_summary(spark, sf):
    return items.dataset_summary(I.interactions(spark, sf), I.catalog(spark, sf))


@query("system_stats", f"""WITH {I.IX} SELECT (SELECT count(*) FROM customer) AS total_users, (SELECT count(*) FROM part) AS total_videos,
  count(*) AS total_interactions, count(DISTINCT CASE WHEN {I.AS_OF} - event_time <= INTERVAL 30 MINUTES THEN user_id END) AS active_sessions FROM ix""")
def system_stats(spark, sf):
    return items.system_stats(I.table(spark, sf, "customer"), I.catalog(spark, sf), I.interactions(spark, sf), I.as_of(spark, sf))


@query("run_summary", f"""WITH {I.IX}, {QUALITY.format(source='ix')} SELECT {r('max(quality_score)', 'max_quality_score')}, {r('avg(engagement_score)', 'avg_engagement_score')},
  count(*) AS videos_analyzed, (SELECT count(DISTINCT user_id) FROM ix) AS users, (SELECT count(*) FROM ix) AS interactions FROM vq""")
def run_summary(spark, sf):
    return items.run_summary(I.interactions(spark, sf), quality(spark, sf))


@query("trending", f"""WITH {I.IX}, s AS (SELECT video_id, count(*) AS interaction_count, sum(weight) AS score FROM ix
  WHERE event_time >= {I.AS_OF} - INTERVAL 24 HOURS GROUP BY 1)
SELECT video_id, interaction_count, {r('score', 'score')}, row_number() OVER (ORDER BY score DESC, video_id) AS rank FROM s ORDER BY score DESC, video_id LIMIT 20""")
def trending(spark, sf):
    return items.trending(I.interactions(spark, sf), I.as_of(spark, sf))


@query("popular_by_count", f"WITH {I.IX} SELECT video_id, count(*) AS interactions FROM ix GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100")
def popular_by_count(spark, sf):
    return items.popular_by_count(I.interactions(spark, sf))


@query("interaction_counter", f"WITH {I.IX} SELECT user_id, count(*) AS total_interactions, {t('max(event_time)', 'last_activity')} FROM ix GROUP BY 1")
def interaction_counter_query(spark, sf):
    return interaction_counter(I.interactions(spark, sf))


def _counters(seconds: int) -> str:
    return f"""WITH {I.IX}, g AS (SELECT *, CASE WHEN event_time - lag(event_time) OVER w > INTERVAL {seconds} SECONDS THEN 1 ELSE 0 END AS b
  FROM ix WINDOW w AS (PARTITION BY video_id ORDER BY event_time, event_id)),
s AS (SELECT *, sum(b) OVER (PARTITION BY video_id ORDER BY event_time, event_id) AS no FROM g),
l AS (SELECT video_id, max(no) AS no FROM s GROUP BY 1 HAVING {I.AS_OF} - max(event_time) <= INTERVAL {seconds} SECONDS)
SELECT s.video_id, event_type, count(*) AS events FROM s JOIN l ON s.video_id = l.video_id AND s.no = l.no GROUP BY 1, 2"""


@query("video_counters", _counters(3600))
def video_counters_query(spark, sf):
    """A timer of one hour, so that pauses occur among few videos."""
    return video_counters(I.interactions(spark, sf), I.as_of(spark, sf), ttl=3600)


@query("video_counters_24h", _counters(86_400))
def video_counters_24h(spark, sf):
    return video_counters(I.interactions(spark, sf), I.as_of(spark, sf))


@query("video_counters_7d", _counters(7 * 86_400))
def video_counters_7d(spark, sf):
    """With the timer of the ingest service."""
    return video_counters(I.interactions(spark, sf), I.as_of(spark, sf), ttl=V.API_COUNTER_TTL)


def _sparsity(source: str) -> str:
    return f"""c AS (SELECT count(DISTINCT user_id) AS users, count(DISTINCT video_id) AS videos, count(*) AS interactions,
  count(DISTINCT user_id || '|' || video_id) AS pairs FROM {source})
SELECT users, videos, interactions, pairs, {r('1 - interactions / (users * videos)::DOUBLE', 'sparsity')}, {r('1 - pairs / (users * videos)::DOUBLE', 'pair_sparsity')} FROM c"""


@query("sparsity", f"WITH {I.BUY}, {_sparsity('buy')}")
def sparsity(spark, sf):
    rows = I.purchases(spark, sf).withColumn("event_type", F.lit("view"))
    return items.sparsity(rows)


@query("item_user_pivot", f"WITH {I.BUY} SELECT video_id, user_id, {r('sum(weight)', 'weight')} FROM buy GROUP BY 1, 2")
def item_user_pivot(spark, sf):
    return items.item_user_weights(I.purchases(spark, sf))


_PIVOT_USERS = ("1", "2", "3")


@query("item_user_pivot_dense", f"WITH {I.IX} SELECT video_id, " + ", ".join(
    r(f"coalesce(sum(weight) FILTER (user_id = '{u}'), 0)", f"user_{u}") for u in _PIVOT_USERS) + " FROM ix GROUP BY 1")
def item_user_pivot_dense(spark, sf):
    """A column for each named user, a row for each video."""
    wide = items.item_user_pivot(I.interactions(spark, sf), list(_PIVOT_USERS))
    return wide.select("video_id", *[F.col(f"`{u}`").alias(f"user_{u}") for u in _PIVOT_USERS])


# ---------------------------------------------------- top-k, set operations


@query("topk_trending", f"""WITH {I.IX}, {I.CCAT}, s AS (SELECT video_id, sum(weight) AS score FROM ix GROUP BY 1)
SELECT video_id, {r('score', 'score')}, title, category, creator_id FROM (SELECT * FROM s ORDER BY score DESC, video_id LIMIT 20) LEFT JOIN ccat USING (video_id)""")
def topk_trending(spark, sf):
    from clipsense.operators.ranking import top

    sums = I.interactions(spark, sf).groupBy("video_id").agg(F.sum("weight").alias("score"))
    return cat.enrich_recommendations(top(sums, "score", "video_id", 20), I.catalog(spark, sf), ("title", "category", "creator_id"))


@query("popular_by_category", f"""WITH {I.CCAT}, k AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY engagement_score DESC NULLS LAST, video_id) AS rank FROM ccat)
SELECT category, video_id, {r('engagement_score', 'engagement_score')}, rank FROM k WHERE rank <= 20""")
def popular_by_category(spark, sf):
    return cat.popular_by_category(I.counted_catalog(spark, sf)).select("category", "video_id", "engagement_score", "rank")


@query("popular_in_category", f"""WITH {I.CCAT}, k AS (SELECT * FROM ccat WHERE category = (SELECT min(category) FROM ccat))
SELECT video_id, {r('engagement_score', 'engagement_score')} FROM k ORDER BY k.engagement_score DESC NULLS LAST, video_id LIMIT 20""")
def popular_in_category(spark, sf):
    catalog = I.counted_catalog(spark, sf)
    first = catalog.agg(F.min("category")).first()[0]
    return cat.popular_by_category(catalog, category=first).select("video_id", "engagement_score")


@query("popular_fallback", f"WITH {I.CCAT} SELECT video_id, views FROM ccat ORDER BY views DESC NULLS LAST, video_id LIMIT 20")
def popular_fallback(spark, sf):
    return cat.popular_by_views(I.counted_catalog(spark, sf)).select("video_id", "views")


@query("sample_users", f"WITH {I.IX} SELECT DISTINCT user_id FROM ix ORDER BY user_id LIMIT 100")
def sample_users(spark, sf):
    return items.sample_users(I.interactions(spark, sf))


UNION_ALL = f"""{I.COM}, {{views}},
un AS (SELECT user_id, video_id, event_type, event_time, weight, watch_time FROM vw
  UNION ALL SELECT user_id, video_id, 'comment', {I.AS_OF}, 3.0::DOUBLE, NULL FROM com
  UNION ALL SELECT user_id, video_id, 'like', event_time, 2.0::DOUBLE, NULL FROM vw WHERE completion_rate >= 0.6::DOUBLE AND {I.draw('like', 'user_id', 'video_id', 'timestamp')} < 0.3::DOUBLE
  UNION ALL SELECT user_id, video_id, 'share', event_time, 4.0::DOUBLE, NULL FROM vw WHERE completion_rate >= 0.8::DOUBLE AND {I.draw('share', 'user_id', 'video_id', 'timestamp')} < 0.1::DOUBLE)"""


def _union_sql(select: str) -> str:
    from checks.column_queries import _VIEW_EVENTS

    return "WITH " + UNION_ALL.format(views=_VIEW_EVENTS) + " " + select


@query("union_interactions", _union_sql(f"SELECT user_id, video_id, event_type, {t('event_time', 'event_time')}, weight, {r('watch_time', 'watch_time')} FROM un"))
def union_interactions(spark, sf):
    views = loading.view_events(I.pairs(spark, sf))
    talk = loading.comment_events(I.comments(spark, sf), I.as_of(spark, sf).cast("timestamp")).drop("comment_length")
    every = items.union_interactions(views, talk, loading.like_events(views), loading.share_events(views))
    return every.select("user_id", "video_id", "event_type", "event_time", "weight", "watch_time")


@query("distinct_keys", f"WITH {I.IX} SELECT 'user' AS kind, user_id AS id FROM ix UNION SELECT 'video', video_id FROM ix")
def distinct_keys(spark, sf):
    ix = I.interactions(spark, sf)
    users, videos = items.distinct_keys(ix, "user_id"), items.distinct_keys(ix, "video_id")
    return users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id")).unionByName(
        videos.select(F.lit("video").alias("kind"), F.col("video_id").alias("id"))
    )
