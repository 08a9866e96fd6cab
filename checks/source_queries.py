"""Sources and sinks: write files from the given tables, read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks.inputs import r, t
from checks.registry import query
from clipsense.operators import items
from clipsense.operators.profiles import full_user_profile
from clipsense.session import scratch_path
from clipsense.sinks import serving, tables
from clipsense.sources import events, files, media, normalise
from clipsense.sources.collection import register
from clipsense.streaming import jobs


def _lines(df, *columns, sep="\t"):
    return df.select(F.concat_ws(sep, *columns).alias("value"))


def view_messages(spark, sf):
    ix = I.interactions(spark, sf).filter(F.col("event_type") == "view")
    stamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")
    return ix.select(
        F.to_json(F.struct("event_type", "user_id", "video_id", stamp, "watch_time", "total_duration", "completion_rate")).alias("value")
    )


def all_messages(spark, sf):
    """Every event with its id, and a comment text on comments, as JSON lines."""
    stamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")
    text = F.when(F.col("event_type") == "comment", F.concat(F.lit("said "), "video_id")).alias("comment_text")
    return I.interactions(spark, sf).select(
        F.to_json(F.struct("event_id", "event_type", "user_id", "video_id", stamp, "watch_time", "total_duration", "completion_rate", text)).alias("value")
    )


def written(df, name, files=4):
    """Write message lines as text files; returns the path."""
    path = scratch_path(df.sparkSession, name)
    df.repartition(files).write.text(path)
    return path


_ISO = "strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f')"


@query("src_view_events", f"""WITH {I.IX}
SELECT event_type, user_id, video_id, {_ISO} AS timestamp, {r('watch_time', 'watch_time')}, {r('total_duration', 'total_duration')},
       {r('completion_rate', 'completion_rate')}, CAST(NULL AS VARCHAR) AS device_type, CAST(NULL AS VARCHAR) AS session_id
FROM ix WHERE event_type = 'view'""")
def src_view_events(spark, sf):
    return events.view_events(spark.read.text(written(view_messages(spark, sf), "views")))


@query("src_interaction_events", f"""WITH {I.IX}
SELECT event_type, user_id, video_id, {_ISO} AS timestamp, CAST(NULL AS VARCHAR) AS session_id,
       CAST(CASE WHEN event_type = 'comment' THEN length('said ' || video_id) END AS BIGINT) AS comment_length
FROM ix WHERE event_type <> 'view'""")
def src_interaction_events(spark, sf):
    lines = spark.read.text(written(all_messages(spark, sf), "acts"))
    return events.interaction_events(lines).filter(F.col("event_type") != "view")


@query("src_pairs_csv", f"WITH {I.PAIRS} SELECT user_id, video_id, timestamp FROM pairs")
def src_pairs_csv(spark, sf):
    path = scratch_path(spark, "pairs")
    I.pairs(spark, sf).toDF("user", "item", "timestamp").write.option("header", True).csv(path)
    return files.pairs_csv(spark, path)


@query("src_titles_csv", f"WITH {I.CAT} SELECT video_id, title FROM cat")
def src_titles_csv(spark, sf):
    path = scratch_path(spark, "titles")
    I.catalog(spark, sf).select("video_id", "title").write.csv(path)
    return files.titles_csv(spark, path)


@query("src_likes_views_tsv", f"WITH {I.LV} SELECT video_id, likes, views FROM lv")
def src_likes_views_tsv(spark, sf):
    path = scratch_path(spark, "likes")
    I.likes_views(spark, sf).write.option("sep", "\t").csv(path)
    return files.likes_views_tsv(spark, path)


@query("src_tags_csv", f"WITH {I.CAT} SELECT video_id, tags FROM cat")
def src_tags_csv(spark, sf):
    path = scratch_path(spark, "tags")
    I.catalog(spark, sf).select("video_id", "tags").write.csv(path)
    return files.tags_csv(spark, path)


@query("src_comments_tsv", f"WITH {I.COM} SELECT user_id, video_id, comment_content FROM com")
def src_comments_tsv(spark, sf):
    path = scratch_path(spark, "comments")
    _lines(I.comments(spark, sf), "user_id", "video_id", "comment_content").write.text(path)
    return files.comments_tsv(spark, path)


@query("src_collection", f"WITH {I.CCAT} SELECT video_id, title, likes, views FROM ccat")
def src_collection(spark, sf):
    path = scratch_path(spark, "collections")
    tables.overwrite(I.counted_catalog(spark, sf), path, "videos")
    return files.collection(spark, path, "videos").select("video_id", "title", "likes", "views")


_PLACES = f"WITH {I.IX} SELECT event_id, user_id, video_id, event_type, watch_time FROM ix WHERE event_type IN ('like', 'share') AND event_id >= 100"
_DOCUMENT = "event_id bigint, event_type string, user_id string, video_id string, watch_time double"


def _documents(spark, sf):
    """All events as JSON documents in eight files, and a broken one of each event in a ninth."""
    path = written(all_messages(spark, sf), "documents", 8)
    all_messages(spark, sf).select(F.substring("value", 1, 20).alias("value")).coalesce(1).write.mode("append").text(path)
    register(spark)
    return path


def _wanted(documents):
    return documents.filter(F.col("event_type").isin("like", "share") & (F.col("event_id") >= 100))


@query("src_collection_json", _PLACES)
def src_collection_json(spark, sf):
    """The connector's batch form, two files a partition; the source takes the filter over."""
    read = spark.read.format("json_collection").schema(_DOCUMENT).option("files", 2).load(_documents(spark, sf))
    return _wanted(read).select("event_id", "user_id", "video_id", "event_type", "watch_time")


@query("src_collection_stream", _PLACES)
def src_collection_stream(spark, sf):
    """The connector's stream form, three files a batch."""
    read = spark.readStream.format("json_collection").schema(_DOCUMENT).option("files_per_batch", 3).load(_documents(spark, sf))
    path, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "progress")
    running = jobs.run(_wanted(read), path, checkpoint, "collection")
    running.processAllAvailable()
    running.stop()
    return spark.read.schema(_DOCUMENT).parquet(path)


@query("src_first_existing", f"WITH {I.CAT} SELECT video_id, title FROM cat")
def src_first_existing(spark, sf):
    path = scratch_path(spark, "candidates")
    I.catalog(spark, sf).select("video_id", "title").write.option("header", True).csv(f"{path}/items.csv")
    return files.first_existing(spark, path, ("videos.csv", "items.csv", "video_features.csv"))


@query("norm_items", """SELECT CAST(p_partkey AS VARCHAR) AS video_id, p_name AS title, p_brand AS creator_id, p_type AS category,
  CAST(p_size AS DOUBLE) AS duration, CAST(0 AS BIGINT) AS view_count, CAST(0 AS BIGINT) AS like_count,
  CAST(0 AS BIGINT) AS share_count, CAST(0 AS BIGINT) AS comment_count, '' AS created_at, '' AS description,
  '1080p' AS resolution, 'en' AS language, replace(p_name, ' ', '|') AS tags FROM part""")
def norm_items(spark, sf):
    foreign = I.table(spark, sf, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("author_id"),
        F.col("p_type").alias("genre"), F.col("p_size").alias("length"),
        F.replace("p_name", F.lit(" "), F.lit(", ")).alias("genres"),
    )
    return normalise.items(foreign)


_RATED = "SELECT CAST(user_id AS VARCHAR) AS user_id, regexp_extract(props, '\"k\":\\s*(-?\\d+)', 1) AS item_id, value / 20.0::DOUBLE AS rating, value AS duration FROM events"


@query("norm_interactions", f"""SELECT user_id, item_id AS video_id, '' AS timestamp, {r('coalesce(duration, 0)', 'watch_time')},
  {r('coalesce(rating, 1)', 'rating')}, CASE WHEN rating >= 4 THEN 'like' WHEN rating >= 3 THEN 'view' ELSE 'skip' END AS event_type
FROM ({_RATED})""")
def norm_interactions(spark, sf):
    foreign = I.table(spark, sf, "events").select(
        "user_id", F.get_json_object("props", "$.k").alias("item_id"),
        (F.col("value") / 20.0).alias("rating"), F.col("value").alias("duration"),
    )
    return normalise.interactions(foreign)


@query("event_from_interaction", f"""SELECT CASE WHEN rating >= 4 THEN 'like' WHEN rating >= 3 THEN 'view' ELSE 'skip' END AS event_type,
  user_id, item_id AS video_id, '' AS timestamp, {r('coalesce(duration, 0)', 'watch_time')}, 60.0::DOUBLE AS total_duration,
  {r('least(1.0::DOUBLE, coalesce(duration, 0) / 60.0::DOUBLE)', 'completion_rate')} FROM ({_RATED})""")
def event_from_interaction(spark, sf):
    return normalise.to_events(norm_interactions(spark, sf))


def _category_files(spark, sf):
    """One file per category, holding the titles of its items."""
    path = scratch_path(spark, "media")
    rows = I.catalog(spark, sf).select(F.col("category").alias("name"), "title")
    rows.repartition("name").write.partitionBy("name").text(path)
    return media.media_files(spark, f"{path}/*", "*.txt", r"name=([^/]+)/")


@query("media_inventory", f"""WITH {I.CAT} SELECT category AS video_id, CAST(sum(length(title) + 1) AS BIGINT) AS length, max(title) AS title,
  true AS has_file, '/api/v1/videos/' || category || '/stream' AS stream_url, '/api/v1/videos/' || category || '/cover' AS cover_url
FROM cat GROUP BY category""")
def media_inventory(spark, sf):
    about = I.catalog(spark, sf).groupBy(F.col("category").alias("video_id")).agg(F.max("title").alias("title"))
    return media.media_inventory(_category_files(spark, sf), about)


@query("media_stats", f"""WITH {I.CAT} SELECT count(DISTINCT category) AS files, CAST(sum(length(title) + 1) AS BIGINT) AS bytes FROM cat""")
def media_stats(spark, sf):
    return media.media_stats(_category_files(spark, sf))


@query("src_sequence_tsv", f"""WITH {I.VISITS} SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_time, event_id) - 1 AS pos, video_id FROM vis""")
def src_sequence_tsv(spark, sf):
    """The format keeps a user's whole history in one line; visits keep lines short."""
    visits = I.visits(spark, sf)
    lines = visits.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_time", "event_id", "video_id"))).alias("s"))
    path = scratch_path(spark, "sequence")
    _lines(lines.select("user_id", F.array_join("s.video_id", " ").alias("v")), "user_id", "v").write.text(path)
    return files.sequence_tsv(spark, path)


@query("src_flag_rows", f"""WITH {I.IX}, f AS (
  SELECT user_id, video_id, epoch_us(event_time) // 1000000 AS s, watch_time, event_type, coalesce(watch_time > 3, false) AS eff FROM ix)
SELECT user_id, video_id, 'view' AS event_type, {t('make_timestamp(s * 1000000)', 'event_time')}, {r('watch_time', 'watch_time')} FROM f WHERE eff
UNION ALL SELECT user_id, video_id, event_type, strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S.%f'), NULL FROM f WHERE event_type <> 'view'""")
def src_flag_rows(spark, sf):
    kind = F.col("event_type")
    no = F.lit(False)
    rows = I.interactions(spark, sf).select(
        "user_id", F.col("video_id").alias("pid"),
        F.floor(F.unix_micros(F.col("event_time").cast("timestamp")) / 1_000_000).alias("exposed_time"),
        F.date_format("event_time", "yyyyMMdd").cast("int").alias("p_date"),
        F.hour("event_time").alias("p_hour"), "watch_time",
        (kind == "like").alias("cvm_like"), (kind == "comment").alias("comment"), no.alias("follow"), no.alias("collect"),
        (kind == "share").alias("forward"), F.coalesce(F.col("watch_time") > 3, no).alias("effective_view"), (kind == "skip").alias("hate"),
    )
    path = scratch_path(spark, "flags")
    rows.write.option("header", True).csv(path)
    return normalise.flag_events(files.flag_rows_csv(spark, path))


@query("flag_attributes", f"""WITH {I.IX}, {I.CAT}, f AS (SELECT user_id, video_id, watch_time FROM ix WHERE watch_time > 3)
SELECT f.user_id, f.video_id, cat.category AS tag_name, c_mktsegment AS fre_community_type,
  {r('CASE WHEN duration > 0 THEN least(1.0::DOUBLE, watch_time / duration) END', 'completion_rate')}
FROM f LEFT JOIN cat USING (video_id) LEFT JOIN customer ON f.user_id = CAST(c_custkey AS VARCHAR)""")
def flag_attributes(spark, sf):
    """Effective views with the attribute tables of the exposure format: parts as items, customers as users."""
    folder = scratch_path(spark, "attributes")
    none = F.lit(None).cast("string")
    I.catalog(spark, sf).select(
        F.col("video_id").alias("pid"), none.alias("category_level"), none.alias("category_id"), none.alias("parent_id"),
        none.alias("root_id"), "duration", F.col("creator_id").alias("author_id"), none.alias("author_fans_count"),
        F.col("category").alias("tag_name"), "title",
    ).write.option("header", True).csv(f"{folder}/items")
    I.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), none.alias("gender"), none.alias("age"), none.alias("mod_price"),
        none.alias("fre_city"), F.col("c_mktsegment").alias("fre_community_type"), none.alias("fre_city_level"),
    ).write.option("header", True).csv(f"{folder}/users")
    joined = normalise.with_attributes(
        src_flag_rows(spark, sf).filter("watch_time IS NOT NULL"),
        files.item_attributes_csv(spark, f"{folder}/items"), files.user_attributes_csv(spark, f"{folder}/users"),
    )
    return joined.select("user_id", "video_id", "tag_name", "fre_community_type", "completion_rate")


# ------------------------------------------------------------------ sinks


@query("sink_overwrite", f"WITH {I.IX} SELECT event_type, count(*) AS events, {r('sum(weight)', 'weight')} FROM ix GROUP BY 1")
def sink_overwrite(spark, sf):
    path = scratch_path(spark, "sink")
    ix = I.interactions(spark, sf)
    for _ in range(2):  # the second write replaces the first
        tables.overwrite(ix, path, "interactions", partition_by=["event_type"])
    return files.collection(spark, path, "interactions").groupBy("event_type").agg(F.count("*").alias("events"), F.sum("weight").alias("weight"))


@query("sink_append", f"WITH {I.IX} SELECT event_type, 2 * count(*) AS events FROM ix GROUP BY 1")
def sink_append(spark, sf):
    path = scratch_path(spark, "sink")
    ix = I.interactions(spark, sf)
    for _ in range(2):
        tables.append(ix, path, "interactions", partition_by=["event_type"])
    tables.append(ix.filter("false"), path, "interactions", partition_by=["event_type"])
    return files.collection(spark, path, "interactions").groupBy("event_type").agg(F.count("*").alias("events"))


@query("upsert_by_key", f"""WITH {I.VISITS},
s AS (SELECT user_id, count(*) AS total_interactions, max(video_id) AS top_video FROM vis GROUP BY 1),
c AS (SELECT user_id, count(*) AS total_interactions, max(watch_time) AS longest FROM vis WHERE event_type = 'view' GROUP BY 1)
SELECT user_id, coalesce(c.total_interactions, s.total_interactions) AS total_interactions, top_video, {r('longest', 'longest')}
FROM s FULL JOIN c USING (user_id)""")
def upsert_by_key(spark, sf):
    """Views of a visit change its stored counters; visits without keep theirs."""
    visits = I.visits(spark, sf)
    stored = visits.groupBy("user_id").agg(F.count("*").alias("total_interactions"), F.max("video_id").alias("top_video"))
    views = visits.filter(F.col("event_type") == "view")
    changes = views.groupBy("user_id").agg(F.count("*").alias("total_interactions"), F.max("watch_time").alias("longest"))
    return tables.upsert_by_key(stored, changes)


@query("sink_hot_profiles", f"""WITH {I.VISITS}, {I.CAT}, p AS (
  SELECT user_id, count(*) FILTER (event_type = 'view') AS v, count(*) FILTER (event_type = 'like') AS l, count(*) FILTER (event_type = 'comment') AS c,
         count(*) FILTER (event_type = 'share') AS s, avg(completion_rate) AS a FROM vis GROUP BY 1),
q AS (SELECT user_id, v, l, (l + c + s) / (v + 1)::DOUBLE AS rate,
         least(100, v * 0.3::DOUBLE + l * 2 + c * 3 + s * 4 + (l + c + s) / (v + 1)::DOUBLE * 50 + coalesce(a, 0) * 30) AS score FROM p)
SELECT 'profile:' || user_id AS key, {r('score', 'user_score')}, CASE WHEN score >= 80 THEN 'power_user' WHEN score >= 50 THEN 'active_user'
  WHEN score >= 20 THEN 'casual_user' ELSE 'new_user' END AS user_type, {r('rate', 'engagement_rate')}, v AS total_views, l AS total_likes,
  {t(I.AS_OF + " + INTERVAL 1 HOUR", 'expires_at')}
FROM q ORDER BY score DESC, user_id LIMIT 1000""")
def sink_hot_profiles(spark, sf):
    people = full_user_profile(I.visits(spark, sf), I.catalog(spark, sf))
    rows = serving.hot_profiles(people, I.as_of(spark, sf))
    shape = "user_score double, user_type string, engagement_rate double, total_views bigint, total_likes bigint"
    return rows.select("key", F.from_json("value", shape).alias("v"), "expires_at").select("key", "v.*", "expires_at")


@query("sink_trending", f"""WITH {I.IX}, s AS (SELECT video_id, sum(weight) AS score FROM ix
  WHERE event_time >= {I.AS_OF} - INTERVAL 24 HOURS GROUP BY 1)
SELECT row_number() OVER (ORDER BY score DESC, video_id) AS rank, video_id, {r('score', 'score')}, {t(I.AS_OF + " + INTERVAL 1 HOUR", 'expires_at')}
FROM s ORDER BY score DESC, video_id LIMIT 100""")
def sink_trending(spark, sf):
    now = I.as_of(spark, sf)
    path = scratch_path(spark, "sink")
    tables.overwrite(serving.trending_snapshot(items.trending(I.interactions(spark, sf), now, n=100), now), path, "trending")
    return files.collection(spark, path, "trending")


@query("sink_event_bus", f"""WITH {I.IX} SELECT CASE WHEN event_type = 'view' THEN 'user-views'
  WHEN event_type IN ('like', 'share', 'comment') THEN 'user-interactions' ELSE 'user-events' END AS topic,
  user_id, video_id, event_type, {r('weight', 'weight')} FROM ix""")
def sink_event_bus(spark, sf):
    path = scratch_path(spark, "bus")
    serving.send_to_files(I.interactions(spark, sf).select("user_id", "video_id", "event_type", "weight"), path)
    shape = "user_id string, video_id string, event_type string, weight double"
    return spark.read.text(path).select("topic", F.from_json("value", shape).alias("v")).select("topic", "v.*")


@query("insert_if_absent", f"""WITH {I.IX}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM ix)
SELECT CASE WHEN k = 1 AND CAST(user_id AS BIGINT) >= 10 THEN 'accepted' ELSE 'refused' END AS outcome, event_id, user_id, video_id FROM n""")
def insert_if_absent(spark, sf):
    """The table holds customers 0..9; every event tries to insert its user."""
    rows = I.interactions(spark, sf).select("user_id", "event_id", "video_id")
    held = I.table(spark, sf, "customer").filter("c_custkey < 10").select(F.col("c_custkey").cast("string").alias("user_id"))
    accepted, refused = tables.insert_if_absent(held, rows, "user_id", "event_id")
    return accepted.withColumn("outcome", F.lit("accepted")).unionByName(refused.withColumn("outcome", F.lit("refused")))


@query("drop_vectors", f"""WITH {I.VISITS} SELECT user_id, count(*) FILTER (event_type = 'view') AS total_views FROM vis GROUP BY 1""")
def drop_vectors(spark, sf):
    from clipsense.ml.clusters import scaled

    people = scaled(full_user_profile(I.visits(spark, sf), I.catalog(spark, sf)))
    plain = tables.drop_vectors(people)
    assert not set(tables.VECTOR_COLUMNS) & set(plain.columns)
    return plain.select("user_id", "total_views")
