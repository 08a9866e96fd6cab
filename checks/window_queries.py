"""Per-user rankings, idle timers and sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks.inputs import r, t
from checks.registry import query
from checks.table_queries import AFFINITY, preferred, ranked_tags
from clipsense.operators import recency


@query("top_tags", f"WITH {I.VISITS}, {I.CAT}, {AFFINITY} SELECT user_id, tags, {r('tags_score', 'tags_score')}, rank FROM tt")
def top_tags(spark, sf):
    return ranked_tags(spark, sf).select("user_id", "tags", "tags_score", "rank")


@query("preferred_tags", f"WITH {I.VISITS}, {I.CAT}, {AFFINITY} SELECT user_id, tag, tag_count, rank FROM pt")
def preferred_tags(spark, sf):
    return preferred(spark, sf).select("user_id", "tag", "tag_count", "rank")


RECENT = """rc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, video_id, event_type) AS rank FROM ix) WHERE rank <= {n})"""


@query("recent_interactions", f"WITH {I.IX}, {RECENT.format(n=100)} SELECT user_id, event_id, rank FROM rc")
def recent_interactions(spark, sf):
    return recency.recent_interactions(I.interactions(spark, sf)).select("user_id", "event_id", "rank")


@query("recent_videos_100", f"""WITH {I.IX}, {RECENT.format(n=100)} SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY rank DESC) AS pos,
  video_id, weight, {t('event_time', 'event_time')} FROM rc""")
def recent_videos_100(spark, sf):
    return recency.recent_videos(I.interactions(spark, sf))


def score_sql(seconds: int = 86_400) -> str:
    return f"""g AS (SELECT *, CASE WHEN event_time - lag(event_time) OVER w > INTERVAL {seconds} SECONDS THEN 1 ELSE 0 END AS b
  FROM ix WINDOW w AS (PARTITION BY user_id ORDER BY event_time, event_id)),
s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS no FROM g),
l AS (SELECT user_id, max(no) AS no FROM s GROUP BY 1 HAVING {I.AS_OF} - max(event_time) <= INTERVAL {seconds} SECONDS),
v AS (SELECT s.user_id, video_id, weight, row_number() OVER (PARTITION BY s.user_id, video_id ORDER BY event_time DESC, event_type DESC) AS k
  FROM s JOIN l ON s.user_id = l.user_id AND s.no = l.no),
rvs AS (SELECT * FROM (SELECT user_id, video_id, weight AS score, row_number() OVER (PARTITION BY user_id ORDER BY weight DESC, video_id) AS rank FROM v WHERE k = 1) WHERE rank <= 50)"""


@query("recent_video_scores", f"WITH {I.IX}, {score_sql()} SELECT user_id, video_id, score, rank FROM rvs")
def recent_video_scores(spark, sf):
    return recency.recent_video_scores(I.interactions(spark, sf), I.as_of(spark, sf))


SESSIONS = """ss AS (SELECT user_id, no + 1 AS session_no, min(event_time) AS started_at, max(event_time) AS ended_at, count(*) AS events,
  coalesce(sum(watch_time), 0) AS watch_time FROM (
    SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS no FROM (
      SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time, event_id) > INTERVAL 30 MINUTES THEN 1 ELSE 0 END AS b FROM ix))
  GROUP BY user_id, no)"""


@query("sessions", f"""WITH {I.IX}, {SESSIONS} SELECT user_id, CAST(session_no AS BIGINT) AS session_no, {t('started_at', 'started_at')}, events, {r('watch_time', 'watch_time')},
  {r("(epoch_us(ended_at) - epoch_us(started_at)) / 1000000.0::DOUBLE", 'duration_seconds')} FROM ss""")
def sessions(spark, sf):
    return recency.sessions(I.interactions(spark, sf))
