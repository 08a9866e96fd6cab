"""Streams over files derived from the given events, run to the end, then read."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import inputs as I
from checks.inputs import r, t
from checks.registry import query
from checks.source_queries import all_messages, view_messages, written
from checks.window_queries import RECENT, SESSIONS
from clipsense.functions.weights import event_weight
from clipsense.session import scratch_path
from clipsense.sources import events
from clipsense.streaming import jobs
from clipsense.streaming.state import latest_lists, recent_videos_state

CLOSING = "closing"
#: Files come in no order of time, so that nothing may count as late before all are read.
ALL = "20000 days"
_EVENT = "event_id bigint, event_type string, user_id string, video_id string, timestamp string, watch_time double, total_duration double, completion_rate double"


def _stream(spark, sf, files=4, per_batch=None):
    """All events as one stream, with times and weights."""
    lines = events.file_topic(spark, written(all_messages(spark, sf), "topic", files), per_batch)
    rows = lines.select(F.from_json("value", _EVENT).alias("data")).select("data.*")
    timed = events.timed(rows)
    return timed.withColumn("weight", event_weight(F.col("event_type"), F.col("completion_rate")))


def _closed(spark, sf):
    """All events in two batches, and two later batches with one event past the watermark each."""
    path = written(all_messages(spark, sf), "topic", 4)
    for year in (2098, 2099):
        late = F.to_json(F.struct(
            F.lit(-1).alias("event_id"), F.lit("view").alias("event_type"), F.lit(CLOSING).alias("user_id"),
            F.lit(CLOSING).alias("video_id"), F.lit(f"{year}-01-01T00:00:00").alias("timestamp"),
        ))
        spark.range(1).select(late.alias("value")).write.mode("append").text(path)
    rows = events.file_topic(spark, path, 2).select(F.from_json("value", _EVENT).alias("data")).select("data.*")
    timed = events.timed(rows)
    return timed.withColumn("weight", event_weight(F.col("event_type"), F.col("completion_rate")))


def _appended(spark, df, name):
    """What the watermark has closed, without the closing events."""
    rows = _append(spark, df, name)
    key = "video_id" if "video_id" in df.columns else "user_id"
    return rows.filter(F.col(key) != CLOSING)


def _finish(spark, start):
    """Run a query to the end of its input and return where it wrote."""
    path, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "progress")
    running = start(path, checkpoint)
    running.awaitTermination()
    return path


def _append(spark, df, name):
    path = _finish(spark, lambda p, c: jobs.run(df, p, c, name, once=True))
    return spark.read.schema(df.schema).parquet(path)


def _complete(spark, df, name):
    """Complete mode: each batch replaces the whole result."""
    def replace(batch, _):
        batch.write.mode("overwrite").parquet(target)

    target = scratch_path(spark, "result")
    _finish(spark, lambda p, c: jobs.run_batches(df, replace, c, name, mode="complete", once=True))
    return spark.read.schema(df.schema).parquet(target)


def with_broken(messages):
    """Every message, and of each a cut-off copy and a list, which are no events."""
    cut = messages.select(F.concat(F.lit("{"), F.substring("value", 3, 20)).alias("value"))
    listed = messages.select(F.concat(F.lit("["), F.substring("value", 2, 20), F.lit("]")).alias("value"))
    return messages.unionByName(cut).unionByName(listed)


@query("stream_rejects", f"WITH {I.IX} SELECT 'broken' AS kind, count(*) AS n FROM ix WHERE event_type = 'view' UNION ALL SELECT 'list', count(*) FROM ix WHERE event_type = 'view'")
def stream_rejects(spark, sf):
    """What the parsers leave out, as it arrived."""
    lines = events.file_topic(spark, written(with_broken(view_messages(spark, sf)), "views"), 2)
    kind = F.when(F.startswith("value", F.lit("[")), "list").otherwise("broken")
    return _append(spark, events.rejects(lines), "rejects").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("stream_weighted_views", f"WITH {I.IX} SELECT user_id, video_id, {t('event_time', 'event_time')}, weight FROM ix WHERE event_type = 'view'")
def stream_weighted_views(spark, sf):
    lines = events.file_topic(spark, written(with_broken(view_messages(spark, sf)), "views"))
    rows = jobs.weighted_views(events.timed(events.view_events(lines)))
    return _append(spark, rows, "weighted_views").select("user_id", "video_id", "event_time", "weight")


@query("stream_weighted_interactions", f"WITH {I.IX} SELECT user_id, video_id, {t('event_time', 'event_time')}, event_type, weight FROM ix WHERE event_type <> 'view'")
def stream_weighted_interactions(spark, sf):
    lines = events.file_topic(spark, written(with_broken(all_messages(spark, sf)), "acts"))
    acts = events.timed(events.interaction_events(lines)).filter(F.col("event_type") != "view")
    return _append(spark, jobs.weighted_interactions(acts), "weighted_acts").select("user_id", "video_id", "event_time", "event_type", "weight")


def _profile_tables(spark, sf):
    """Two files per batch, so that several batches are merged."""
    stream = _stream(spark, sf, files=4, per_batch=2)
    path = scratch_path(spark, "profiles")
    state = jobs.ProfileTables(spark, path, "first")
    _finish(spark, lambda p, c: jobs.run_batches(stream, state.write_batch, c, "profiles", once=True))
    return state


@query("stream_profile_upsert", f"""WITH {I.IX}, {RECENT.format(n=100)}, c AS (SELECT user_id, count(*) AS total_interactions, max(event_time) AS last FROM ix GROUP BY 1)
SELECT user_id, total_interactions, {t('last', 'last_activity')}, video_id, weight, rank FROM rc JOIN c USING (user_id)""")
def stream_profile_upsert(spark, sf):
    state = _profile_tables(spark, sf)
    return state.recent().select("user_id", "video_id", "weight", "rank").join(state.counters(), "user_id")


@query("sink_foreach_batch", f"WITH {I.IX} SELECT event_type, count(*) AS events, {r('sum(weight)', 'weight')} FROM ix GROUP BY 1")
def sink_foreach_batch(spark, sf):
    return _profile_tables(spark, sf).interactions().groupBy("event_type").agg(F.count("*").alias("events"), F.sum("weight").alias("weight"))


@query("sink_console", f"WITH {I.IX} SELECT count(*) AS rows, count(*) AS shown FROM ix WHERE event_type = 'view'")
def sink_console(spark, sf):
    """The rows the console query has read and written, by its own progress reports."""
    lines = events.file_topic(spark, written(view_messages(spark, sf), "views"))
    running = jobs.run_console(events.view_events(lines), scratch_path(spark, "progress"), "console", once=True)
    running.awaitTermination()
    done = [p for p in running.recentProgress if p["numInputRows"]]
    return spark.createDataFrame(
        [(sum(p["numInputRows"] for p in done), sum(p["observedMetrics"][jobs.CONSOLE_ROWS]["rows"] for p in done))], "rows bigint, shown bigint"
    )


@query("stream_trending", f"""WITH {I.IX}, b AS (SELECT *, date_trunc('day', event_time) AS w FROM ix)
SELECT {t('w', 'window_start')}, {t('w + INTERVAL 24 HOURS', 'window_end')}, video_id, count(*) AS interaction_count, {r('sum(weight)', 'score')} FROM b GROUP BY w, video_id""")
def stream_trending(spark, sf):
    return _appended(spark, jobs.trending_windows(_closed(spark, sf), watermark=ALL), "trending")


@query("stream_trending_sliding", f"""WITH {I.IX}, b AS (SELECT *, unnest(range(0, 4)) AS k FROM ix), c AS (SELECT *, time_bucket(INTERVAL 6 HOURS, event_time, TIMESTAMP '2000-01-01') - k * INTERVAL 6 HOURS AS w FROM b)
SELECT {t('w', 'window_start')}, {t('w + INTERVAL 24 HOURS', 'window_end')}, video_id, count(*) AS interaction_count, {r('sum(weight)', 'score')} FROM c GROUP BY w, video_id""")
def stream_trending_sliding(spark, sf):
    return _appended(spark, jobs.trending_windows(_closed(spark, sf), slide="6 hours", watermark=ALL), "trending_sliding")


@query("stream_watch_metrics", f"""WITH {I.IX}, b AS (SELECT *, date_trunc('day', event_time) AS w FROM ix)
SELECT {t('w', 'window_start')}, video_id, count(*) FILTER (event_type = 'view') AS views, {r("sum(watch_time) FILTER (event_type = 'view')", 'watch_time')},
  {r("avg(completion_rate) FILTER (event_type = 'view')", 'avg_completion_rate')}, count(*) FILTER (event_type IN ('like', 'comment', 'share')) AS engagements FROM b GROUP BY w, video_id""")
def stream_watch_metrics(spark, sf):
    return _appended(spark, jobs.watch_metrics(_closed(spark, sf), watermark=ALL), "watch_metrics")


@query("stream_recent_state", f"""WITH {I.IX}, o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, video_id) AS pos,
    lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time DESC, video_id) AS newer FROM ix),
h AS (SELECT *, sum(CASE WHEN newer - event_time > INTERVAL 24 HOURS THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY pos) AS pauses FROM o WHERE pos <= 100)
SELECT user_id, video_id, weight, pos, {t('event_time', 'event_time')} FROM h WHERE pauses = 0""")
def stream_recent_state(spark, sf):
    """Lists change from batch to batch; the last one of each user counts."""
    rows = _append(spark, recent_videos_state(_stream(spark, sf, files=6, per_batch=2), watermark=ALL), "recent_state")
    return latest_lists(rows).select("user_id", "video_id", "weight", "pos", F.timestamp_micros("event_us").alias("event_time"))


@query("stream_video_counters", f"""WITH {I.IX}, g AS (SELECT *, CASE WHEN event_time - lag(event_time) OVER w > INTERVAL 2 HOURS THEN 1 ELSE 0 END AS b
  FROM ix WINDOW w AS (PARTITION BY video_id ORDER BY event_time, event_id)),
s AS (SELECT *, sum(b) OVER (PARTITION BY video_id ORDER BY event_time, event_id) AS no FROM g)
SELECT video_id, {t('min(event_time)', 'started_at')}, {t('max(event_time) + INTERVAL 2 HOURS', 'expires_at')},
  {', '.join(f"count(*) FILTER (event_type = '{k}') AS {k}_count" for k in ('view', 'like', 'share', 'comment', 'skip'))} FROM s GROUP BY video_id, no""")
def stream_video_counters(spark, sf):
    """A timer of two hours, so that there are pauses."""
    return _appended(spark, jobs.video_counter_sessions(_closed(spark, sf), ttl=7200, watermark=ALL), "video_counters")


@query("stream_sessions", f"""WITH {I.IX}, {SESSIONS} SELECT user_id, {t('started_at', 'started_at')}, events, {r('watch_time', 'watch_time')},
  {r("(epoch_us(ended_at) - epoch_us(started_at)) / 1000000.0::DOUBLE", 'duration_seconds')} FROM ss""")
def stream_sessions(spark, sf):
    return _appended(spark, jobs.user_sessions(_closed(spark, sf), watermark=ALL), "sessions")


@query("stream_dedup", f"WITH {I.IX} SELECT event_id, user_id, video_id, {t('event_time', 'event_time')} FROM ix")
def stream_dedup(spark, sf):
    """Every message is sent twice."""
    sent = all_messages(spark, sf)
    lines = events.file_topic(spark, written(sent.unionByName(sent), "twice"))
    rows = events.timed(lines.select(F.from_json("value", _EVENT).alias("data")).select("data.*"))
    return _append(spark, jobs.deduplicated(rows), "dedup").select("event_id", "user_id", "video_id", "event_time")


@query("stream_catalog_latest", f"""WITH {I.IX}, k AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY event_time DESC, event_id DESC) AS k FROM ix)
SELECT video_id, 'seen by ' || user_id AS title, event_type AS category, {t('event_time', 'event_time')} FROM k WHERE k = 1""")
def stream_catalog_latest(spark, sf):
    """The metadata topic: each event sends its video's metadata anew."""
    stamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at")
    sent = I.interactions(spark, sf).select(F.to_json(F.struct(
        "video_id", F.concat(F.lit("seen by "), "user_id").alias("title"), F.col("event_type").alias("category"), stamp
    )).alias("value"))
    changes = events.item_events(events.file_topic(spark, written(with_broken(sent), "metadata"), 4))
    latest = jobs.catalog_latest(changes.withColumn("event_time", F.to_timestamp("created_at")))
    return _complete(spark, latest, "catalog").select("video_id", "title", "category", "event_time")


@query("stream_session_totals", f"""WITH {I.IX}, b AS (SELECT *, user_id || '-' || event_type AS session_id, date_trunc('day', event_time) AS w FROM ix)
SELECT {t('w', 'window_start')}, session_id, count(*) AS events, {r('coalesce(sum(watch_time), 0)', 'watch_time')},
  {t('min(event_time)', 'started_at')}, {t('max(event_time)', 'ended_at')} FROM b GROUP BY w, session_id""")
def stream_session_totals(spark, sf):
    """Sessions as the clients name them: here a user's events of one type."""
    rows = _closed(spark, sf).withColumn("session_id", F.concat_ws("-", "user_id", "event_type"))
    totals = _append(spark, jobs.session_totals(rows, watermark=ALL), "session_totals")
    return totals.filter(~F.startswith("session_id", F.lit(CLOSING)))


@query("stream_ingest_api", f"""WITH {I.IX} SELECT CASE WHEN event_type = 'skip' THEN 'rejected' WHEN event_type = 'view' THEN 'user-views' ELSE 'user-interactions' END AS topic,
  event_id, user_id, true AS stamped, true AS as_sent FROM ix
  UNION ALL SELECT 'rejected', NULL, NULL, true, true FROM ix UNION ALL SELECT 'rejected', NULL, NULL, true, true FROM ix""")
def stream_ingest_api(spark, sf):
    """Skips arrive without a video and have to be rejected, and so have broken lines."""
    sent = all_messages(spark, sf).withColumn("value", F.when(
        F.contains("value", F.lit('"event_type":"skip"')), F.regexp_replace("value", '"video_id":"[^"]*",', "")
    ).otherwise(F.col("value")))
    lines = events.file_topic(spark, written(with_broken(sent), "calls"), 2)
    path = scratch_path(spark, "ingest")
    handler = jobs.ingest(path, T.StructType.fromDDL(_EVENT), "first")
    _finish(spark, lambda p, c: jobs.run_batches(lines, handler, c, "ingest", once=True))
    as_sent = F.coalesce(F.get_json_object("value", "$.event_id").cast("bigint") == F.col("event_id"), F.col("event_id").isNull())
    return spark.read.parquet(path).select(
        "topic", "event_id", "user_id", (F.col("received_at") <= F.current_timestamp()).alias("stamped"), as_sent.alias("as_sent")
    )
