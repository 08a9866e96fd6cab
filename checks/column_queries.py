"""Derived columns, filters and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks.inputs import draw, r, t
from checks.registry import query
from clipsense.functions import events as E
from clipsense.functions import items as C
from clipsense.functions import users as U
from clipsense.functions import weights as W
from clipsense.ml.ids import id_index, indexed
from clipsense.operators import catalog as cat
from clipsense.operators import loading, profiles, search
from clipsense.operators.recency import interaction_counter
from clipsense.session import scratch_path
from clipsense.streaming.jobs import with_processing_time


@query("w_view", f"WITH {I.IX} SELECT event_id, weight FROM ix WHERE event_type = 'view'")
def w_view(spark, sf):
    views = I.interactions(spark, sf).filter(F.col("event_type") == "view")
    return views.select("event_id", W.view_weight(F.col("completion_rate")).alias("weight"))


@query("w_interaction", f"WITH {I.IX} SELECT event_id, CASE WHEN event_type = 'view' THEN 1.0::DOUBLE ELSE weight END AS weight FROM ix")
def w_interaction(spark, sf):
    return I.interactions(spark, sf).select("event_id", W.interaction_weight(F.col("event_type")).alias("weight"))


@query("w_loader", f"""WITH {I.IX} SELECT event_id, CASE event_type WHEN 'view' THEN 1.0::DOUBLE WHEN 'like' THEN 2.0::DOUBLE
  WHEN 'comment' THEN 3.0::DOUBLE WHEN 'share' THEN 4.0::DOUBLE END AS weight FROM ix""")
def w_loader(spark, sf):
    return I.interactions(spark, sf).select("event_id", W.loader_weight(F.col("event_type")).alias("weight"))


@query("processing_time", f"WITH {I.IX} SELECT event_id, true AS stamped FROM ix")
def processing_time(spark, sf):
    stamped = with_processing_time(I.interactions(spark, sf))
    return stamped.select("event_id", F.col("processing_time").isNotNull().alias("stamped"))


_VIEW_EVENTS = f"""{I.PAIRS}, vw0 AS (SELECT *, 10.0::DOUBLE + {draw('watch', 'user_id', 'video_id', 'timestamp')} * 60.0::DOUBLE AS watch_time FROM pairs),
vw AS (SELECT user_id, video_id, 'view' AS event_type, make_timestamp(timestamp * 1000) AS event_time, timestamp, 1.0::DOUBLE AS weight, watch_time,
  60.0::DOUBLE AS total_duration, watch_time / 60.0::DOUBLE AS completion_rate FROM vw0)"""


@query("view_events", f"""WITH {_VIEW_EVENTS} SELECT user_id, video_id, event_type, {t('event_time', 'event_time')}, weight,
  {r('watch_time', 'watch_time')}, total_duration, {r('completion_rate', 'completion_rate')} FROM vw""")
def view_events(spark, sf):
    return loading.view_events(I.pairs(spark, sf))


@query("comment_events", f"""WITH {I.COM} SELECT user_id, video_id, 'comment' AS event_type, {t(I.AS_OF, 'event_time')}, 3.0::DOUBLE AS weight,
  CAST(NULL AS DOUBLE) AS watch_time, CAST(NULL AS DOUBLE) AS total_duration, CAST(NULL AS DOUBLE) AS completion_rate,
  length(comment_content) AS comment_length FROM com""")
def comment_events(spark, sf):
    return loading.comment_events(I.comments(spark, sf), I.as_of(spark, sf))


@query("sample_likes_shares", f"""WITH {_VIEW_EVENTS}
SELECT user_id, video_id, 'like' AS event_type, {t('event_time', 'event_time')}, 2.0::DOUBLE AS weight FROM vw
 WHERE completion_rate >= 0.6::DOUBLE AND {draw('like', 'user_id', 'video_id', 'timestamp')} < 0.3::DOUBLE
UNION ALL SELECT user_id, video_id, 'share', strftime(event_time, '%Y-%m-%d %H:%M:%S.%f'), 4.0::DOUBLE FROM vw
 WHERE completion_rate >= 0.8::DOUBLE AND {draw('share', 'user_id', 'video_id', 'timestamp')} < 0.1::DOUBLE""")
def sample_likes_shares(spark, sf):
    views = loading.view_events(I.pairs(spark, sf))
    both = loading.like_events(views).unionByName(loading.share_events(views))
    return both.select("user_id", "video_id", "event_type", "event_time", "weight")


@query("engagement_ratio", f"WITH {I.LV} SELECT video_id, {r('CAST(likes AS DOUBLE) / (views + 1) * 100', 'engagement_score')} FROM lv")
def engagement_ratio(spark, sf):
    return I.likes_views(spark, sf).select("video_id", C.engagement_ratio(F.col("likes"), F.col("views")).alias("engagement_score"))


@query("media_urls", f"""WITH {I.CAT} SELECT video_id, '/api/v1/videos/' || video_id || '/stream' AS video_url,
  '/api/v1/videos/' || video_id || '/cover' AS cover_url FROM cat""")
def media_urls(spark, sf):
    return I.catalog(spark, sf).select(
        "video_id", C.media_url(F.col("video_id"), "stream").alias("video_url"), C.media_url(F.col("video_id"), "cover").alias("cover_url")
    )


@query("engagement_age_score", f"""WITH {I.IX}, c AS (SELECT video_id, count(*) FILTER (event_type = 'view') AS v, count(*) FILTER (event_type = 'like') AS l,
  count(*) FILTER (event_type = 'share') AS s, count(*) FILTER (event_type = 'comment') AS k, min(event_time) AS created FROM ix GROUP BY 1)
SELECT video_id, {r("(v + 5 * l + 10 * s + 8 * k) / greatest(1, floor(epoch(" + I.AS_OF + " - created) / 86400) + 1)", 'score')} FROM c""")
def engagement_age_score(spark, sf):
    from clipsense.operators.items import count_of

    counts = I.interactions(spark, sf).groupBy("video_id").agg(
        *[count_of(kind).alias(f"{kind}_count") for kind in ("view", "like", "share", "comment")], F.min("event_time").alias("created_at")
    )
    return counts.select("video_id", C.engagement_age_score(F.col("created_at"), I.as_of(spark, sf)).alias("score"))


@query("rating_to_event_type", """SELECT event_id, CASE WHEN value / 20.0::DOUBLE >= 4 THEN 'like' WHEN value / 20.0::DOUBLE >= 3 THEN 'view' ELSE 'skip' END AS event_type FROM events""")
def rating_to_event_type(spark, sf):
    return I.table(spark, sf, "events").select("event_id", E.rating_event_type(F.col("value") / 20.0).alias("event_type"))


@query("parse_tags", """SELECT CAST(p_partkey AS VARCHAR) AS video_id, form, p_name AS words,
  CASE form WHEN 'comma' THEN array_to_string(list_transform(string_split(replace(p_name, ' ', ', '), ','), lambda x: trim(x)), '|')
            WHEN 'pipe' THEN array_to_string(string_split(replace(p_name, ' ', ' |'), '|'), '|') ELSE p_name END AS tags
FROM part, (VALUES ('comma'), ('pipe'), ('single')) f(form)""")
def parse_tags(spark, sf):
    words = I.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("video_id"), F.col("p_name").alias("words"))
    forms = F.array(
        F.struct(F.lit("comma").alias("form"), F.replace("words", F.lit(" "), F.lit(", ")).alias("text")),
        F.struct(F.lit("pipe").alias("form"), F.replace("words", F.lit(" "), F.lit(" |")).alias("text")),
        F.struct(F.lit("single").alias("form"), F.col("words").alias("text")),
    )
    rows = words.select("video_id", "words", F.explode(forms).alias("f"))
    return rows.select("video_id", "f.form", "words", C.parse_tags(F.col("f.text")).alias("tags"))


def _holey(spark, sf):
    """Events as a client may send them: a zero-valued event lacks its video."""
    ix = I.interactions(spark, sf)
    return ix.withColumn("video_id", F.when(F.col("event_type") != "skip", F.col("video_id"))).select("event_id", "event_type", "user_id", "video_id")


_HOLEY = f"{I.IX}, holey AS (SELECT event_id, event_type, user_id, CASE WHEN event_type <> 'skip' THEN video_id END AS video_id FROM ix)"


@query("validate_events", f"WITH {_HOLEY} SELECT event_id, video_id IS NOT NULL AS valid, true AS stamped FROM holey")
def validate_events(spark, sf):
    valid, rejected = loading.validate(_holey(spark, sf), F.current_timestamp())
    every = valid.withColumn("valid", F.lit(True)).unionByName(rejected.withColumn("valid", F.lit(False)))
    return every.select("event_id", "valid", (F.col("received_at") <= F.current_timestamp()).alias("stamped"))


@query("route_events", f"""WITH {I.IX} SELECT event_id, CASE WHEN event_type = 'view' THEN 'user-views'
  WHEN event_type IN ('like', 'share', 'comment') THEN 'user-interactions' ELSE 'user-events' END AS topic FROM ix""")
def route_events(spark, sf):
    return loading.route(I.interactions(spark, sf)).select("event_id", "topic")


@query("filter_indexed", f"""WITH {I.IX} SELECT event_id, weight FROM ix WHERE user_id IN (SELECT user_id FROM ix WHERE event_type = 'like')
  AND video_id IN (SELECT video_id FROM ix WHERE event_type = 'like')""")
def filter_indexed(spark, sf):
    ix = I.interactions(spark, sf)
    likes = ix.filter(F.col("event_type") == "like")
    known = indexed(ix, id_index(likes, "user_id", "user_idx"), id_index(likes, "video_id", "video_idx"))
    return known.select("event_id", "weight")


@query("search_catalog", f"""WITH {I.CAT} SELECT video_id, title, category FROM cat
WHERE contains(lower(title), 'bolt') OR contains(lower(video_id), 'bolt') OR contains(lower(category), 'bolt')""")
def search_catalog(spark, sf):
    return cat.search(I.catalog(spark, sf), "BOLT").select("video_id", "title", "category")


#: Patterns that titles begin with, of so many characters, in capitals.
_LENGTHS = (1, 2, 3, 4, 7, 12, 20)


@query("search_catalog_indexed", f"""WITH {I.CAT}, p AS (SELECT upper(substr(title, 1, n)) AS pattern FROM (SELECT min(title) AS title FROM cat), (SELECT unnest({list(_LENGTHS)}) AS n))
SELECT pattern, video_id FROM p, cat WHERE contains(lower(title), lower(pattern)) OR contains(lower(video_id), lower(pattern)) OR contains(lower(category), lower(pattern))""")
def search_catalog_indexed(spark, sf):
    """Patterns of 1 to 20 characters by the posting table."""
    videos, path = I.catalog(spark, sf), scratch_path(spark, "postings")
    search.write_postings(videos, path)
    index, title = spark.read.parquet(path), videos.agg(F.min("title")).first()[0]
    found = None
    for pattern in (title[:n].upper() for n in _LENGTHS):
        rows = search.search_indexed(index, videos, pattern).select(F.lit(pattern).alias("pattern"), "video_id")
        found = rows if found is None else found.unionByName(rows)
    return found


@query("comment_length", f"WITH {I.COM} SELECT user_id, video_id, length(comment_content) AS comment_length FROM com")
def comment_length(spark, sf):
    text = F.col("comment_content")
    return I.comments(spark, sf).select("user_id", "video_id", E.comment_length(F.lit(None).cast("int"), text).alias("comment_length"))


def profile_sql(source: str) -> str:
    """Scored profiles ``up`` of the users in ``source`` (ix or vis)."""
    return f"""{I.VISITS}, {I.CAT}, pr AS (
  SELECT user_id, count(*) FILTER (event_type = 'view') AS total_views, avg(watch_time) FILTER (event_type = 'view') AS avg_watch_time,
    avg(completion_rate) FILTER (event_type = 'view') AS avg_completion_rate, count(*) FILTER (event_type = 'like') AS total_likes,
    count(*) FILTER (event_type = 'comment') AS total_comments, count(*) FILTER (event_type = 'share') AS total_shares,
    count(*) FILTER (event_type = 'collect') AS total_collects, count(DISTINCT video_id) AS unique_videos_watched,
    count(DISTINCT tags) AS unique_categories, min(event_time) AS first_interaction, max(event_time) AS last_interaction
  FROM {source} LEFT JOIN cat USING (video_id) GROUP BY 1),
dp AS (SELECT *, (total_likes + total_comments + total_shares) / (total_views + 1)::DOUBLE AS engagement_rate,
    date_diff('day', CAST(first_interaction AS DATE), CAST(last_interaction AS DATE)) + 1 AS active_days FROM pr),
sp AS (SELECT *, total_views / (active_days + 1)::DOUBLE AS activity_frequency,
    least(100.0::DOUBLE, total_views * 0.3::DOUBLE + total_likes * 2.0::DOUBLE + total_comments * 3.0::DOUBLE + total_shares * 4.0::DOUBLE
      + engagement_rate * 50.0::DOUBLE + coalesce(avg_completion_rate, 0) * 30.0::DOUBLE) AS user_score FROM dp),
up AS (SELECT *, CASE WHEN user_score >= 80 THEN 'power_user' WHEN user_score >= 50 THEN 'active_user'
    WHEN user_score >= 20 THEN 'casual_user' ELSE 'new_user' END AS user_type FROM sp)"""


PROFILE = profile_sql("vis")


def visit_profiles(spark, sf):
    return profiles.full_user_profile(I.visits(spark, sf), I.catalog(spark, sf))


@query("user_type", f"WITH {PROFILE} SELECT user_id, {r('user_score', 'user_score')}, user_type FROM up")
def user_type(spark, sf):
    return visit_profiles(spark, sf).select("user_id", "user_score", "user_type")


@query("segment_label", f"""WITH {PROFILE}, n AS (SELECT user_id, total_views % 6 AS segment_no FROM up)
SELECT user_id, segment_no, CASE segment_no WHEN 0 THEN 'casual_browsers' WHEN 1 THEN 'engaged_viewers' WHEN 2 THEN 'power_users'
  WHEN 3 THEN 'new_users' ELSE 'churned_users' END AS user_segment FROM n""")
def segment_label(spark, sf):
    numbered = visit_profiles(spark, sf).select("user_id", (F.col("total_views") % 6).alias("segment_no"))
    return numbered.withColumn("user_segment", U.segment_label(F.col("segment_no")))


@query("diversity_bonus", f"""WITH {I.IX}, n AS (SELECT user_id, video_id, count(DISTINCT event_type) AS methods FROM ix GROUP BY 1, 2)
SELECT user_id, video_id, CASE WHEN methods >= 3 THEN 10.0::DOUBLE WHEN methods = 2 THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS bonus FROM n""")
def diversity_bonus(spark, sf):
    n = I.interactions(spark, sf).groupBy("user_id", "video_id").agg(F.count_distinct("event_type").alias("methods"))
    return n.select("user_id", "video_id", U.diversity_bonus(F.col("methods")).alias("bonus"))


METHOD_WEIGHTS = """mw(user_type, method, method_weight) AS (VALUES
  ('power_user', 'likes', 0.4::DOUBLE), ('power_user', 'comments', 0.4::DOUBLE), ('power_user', 'watch_patterns', 0.2::DOUBLE),
  ('active_user', 'likes', 0.35::DOUBLE), ('active_user', 'comments', 0.35::DOUBLE), ('active_user', 'watch_patterns', 0.3::DOUBLE),
  ('casual_user', 'likes', 0.3::DOUBLE), ('casual_user', 'comments', 0.2::DOUBLE), ('casual_user', 'watch_patterns', 0.5::DOUBLE),
  ('new_user', 'likes', 0.3::DOUBLE), ('new_user', 'comments', 0.2::DOUBLE), ('new_user', 'watch_patterns', 0.5::DOUBLE),
  ('none', 'likes', 0.33::DOUBLE), ('none', 'comments', 0.33::DOUBLE), ('none', 'watch_patterns', 0.34::DOUBLE))"""


@query("method_weights", f"""WITH {PROFILE}, {METHOD_WEIGHTS}, us AS (SELECT user_id FROM vis UNION SELECT user_id FROM ix)
SELECT us.user_id, mw.method, mw.method_weight FROM us LEFT JOIN up USING (user_id) JOIN mw ON mw.user_type = coalesce(up.user_type, 'none')""")
def method_weights(spark, sf):
    from clipsense.operators.recommend import with_method_weights

    users = I.visits(spark, sf).select("user_id").union(I.interactions(spark, sf).select("user_id")).distinct()
    methods = F.explode(F.array(*map(F.lit, ("likes", "comments", "watch_patterns"))))
    weighted = with_method_weights(users.withColumn("method", methods), visit_profiles(spark, sf))
    return weighted.select("user_id", "method", "method_weight")


@query("fill_features", f"""WITH {PROFILE} SELECT user_id, total_views, total_likes, total_comments, {r('engagement_rate', 'engagement_rate')},
  {r('coalesce(avg_completion_rate, 0)', 'avg_completion_rate')}, {r('activity_frequency', 'activity_frequency')} FROM up""")
def fill_features(spark, sf):
    from clipsense.fixed_values import CLUSTER_FEATURES

    return profiles.fill_features(visit_profiles(spark, sf)).select("user_id", *CLUSTER_FEATURES)


@query("lookup_by_key", f"WITH {profile_sql('ix')} SELECT user_id, total_views, active_days FROM up WHERE user_id = '7'")
def lookup_by_key(spark, sf):
    everyone = profiles.derived(profiles.user_profile(I.interactions(spark, sf), I.catalog(spark, sf)))
    return cat.lookup_by_key(everyone, "user_id", "7").select("user_id", "total_views", "active_days")


@query("profile_or_default", f"""WITH {I.IX}, c AS (SELECT user_id, count(*) AS n, max(event_time) AS last FROM ix GROUP BY 1)
SELECT CAST(c_custkey AS VARCHAR) AS user_id, coalesce(n, 0) AS total_interactions, {t('last', 'last_activity')},
  coalesce(CASE WHEN n IS NOT NULL THEN 'general' END, '') AS favorite_categories,
  CASE WHEN n IS NULL THEN {t(I.AS_OF, 'x').rsplit(' AS ', 1)[0]} END AS created_at
FROM customer LEFT JOIN c ON c.user_id = CAST(c_custkey AS VARCHAR)""")
def profile_or_default(spark, sf):
    users = I.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    held = interaction_counter(I.interactions(spark, sf)).withColumn("favorite_categories", F.array(F.lit("general")))
    return profiles.profile_or_default(users, held, I.as_of(spark, sf))
