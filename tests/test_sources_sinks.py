"""Files as they come, and tables as they are kept."""

import pytest
from pyspark.sql import functions as F

from clipsense import schemas
from clipsense.operators import catalog as cat
from clipsense.operators import items, loading
from clipsense.sinks import serving, tables
from clipsense.sources import events, files, media, normalise


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_both_pair_headers(spark, tmp_path):
    a = files.pairs_csv(spark, write(tmp_path / "a.csv", "user,item,timestamp\n1,2,1704067200000\n"))
    b = files.pairs_csv(spark, write(tmp_path / "b.csv", "userID,videoID,timestamp\n1,2,oops\n"))
    assert [tuple(r) for r in a.collect()] == [("1", "2", 1704067200000)]
    assert [tuple(r) for r in b.collect()] == [("1", "2", None)]


def test_titles_with_quotes_and_header(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'video_id,title\n1,"Say ""hi"", now"\n2,plain\n')
    assert {tuple(r) for r in files.titles_csv(spark, path).collect()} == {("1", 'Say "hi", now'), ("2", "plain")}


def test_comments_keep_quotes(spark, tmp_path):
    path = write(tmp_path / "c.tsv", 'u1\tv1\t"well\nu2\tv2\tit\'s "so" good\n')
    assert [r.comment_content for r in files.comments_tsv(spark, path).orderBy("user_id").collect()] == ['"well', "it's \"so\" good"]


def test_sequences_keep_positions(spark, tmp_path):
    path = write(tmp_path / "s.tsv", "u1\t9 8 9\nu2\t7\n")
    assert {tuple(r) for r in files.sequence_tsv(spark, path).collect()} == {("u1", 0, "9"), ("u1", 1, "8"), ("u1", 2, "9"), ("u2", 0, "7")}


def test_first_existing_and_missing(spark, tmp_path):
    write(tmp_path / "items.csv", "id,name\n1,x\n")
    assert files.first_existing(spark, str(tmp_path), ("videos.csv", "items.csv")).count() == 1
    with pytest.raises(FileNotFoundError):
        files.first_existing(spark, str(tmp_path), ("none.csv",))


def test_collection_not_written_yet_is_empty(spark, tmp_path):
    empty = files.collection(spark, str(tmp_path), "recommendations", schemas.INTERACTION)
    assert empty.count() == 0 and empty.schema == schemas.INTERACTION


def test_bad_json_goes_to_rejects(spark):
    rows = ["{broken", '{"event_type":"view","user_id":"u"}', "[]", '{"other":1}']
    values = spark.createDataFrame([(r,) for r in rows], "value string")
    assert {r.value for r in events.rejects(values).collect()} == {"{broken", "[]", '{"other":1}'}


def test_comment_length_comes_from_either_field(spark):
    rows = ['{"event_type":"comment","comment_text":"hello"}', '{"event_type":"comment","comment_length":3}', '{"event_type":"like"}']
    df = events.interaction_events(spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1))
    assert [r.comment_length for r in df.collect()] == [5, 3, None]
    assert len(df.columns) == 6


def test_item_fields_fall_back(spark):
    df = spark.createDataFrame([("7", None, "a|b")], "id string, title string, tags string")
    row = normalise.items(df).first()
    assert (row.video_id, row.title, row.creator_id, row.duration, row.tags) == ("7", "Untitled", "unknown", 30.0, ["a", "b"])


def test_item_tags_may_be_arrays(spark):
    df = spark.createDataFrame([("7", ["a", "b"]), ("8", None)], "id string, hashtags array<string>")
    assert [r.tags for r in normalise.items(df).orderBy("video_id").collect()] == [["a", "b"], []]


def test_interaction_type_given_wins_over_rating(spark):
    df = spark.createDataFrame([("u", "v", 5.0, "share"), ("u", "w", 5.0, None)], "user_id string, item_id string, rating double, type string")
    assert [r.event_type for r in normalise.interactions(df).orderBy("video_id").collect()] == ["share", "like"]


def test_flag_rows_to_events(spark):
    row = ("u", "p", 1663471335, 20220917, 11, 46.0, True, False, False, True, False, True, False)
    found = normalise.flag_events(spark.createDataFrame([row], schemas.FLAG_ROWS)).collect()
    assert {(r.event_type, r.watch_time) for r in found} == {("like", None), ("collect", None), ("view", 46.0)}


def test_media_inventory_keeps_files_without_metadata(spark, tmp_path):
    for name in ("v1", "v2"):
        write(tmp_path / f"{name}.mp4", "12345")
    write(tmp_path / "cover.jpg", "x")
    about = spark.createDataFrame([("v1", "One"), ("v9", "Nine")], "video_id string, title string")
    found = media.media_files(spark, str(tmp_path))
    rows = {r.video_id: (r.title, r.has_file, r.stream_url) for r in media.media_inventory(found, about).collect()}
    assert rows == {"v1": ("One", True, "/api/v1/videos/v1/stream"), "v2": (None, True, "/api/v1/videos/v2/stream")}
    assert tuple(media.media_stats(found).first()) == (2, 10)


def test_duplicate_titles_do_not_fan_out(spark):
    ids = spark.createDataFrame([("1",), ("1",), ("2",)], "video_id string")
    titles = spark.createDataFrame([("1", "b"), ("1", "a")], "video_id string, title string")
    lv = spark.createDataFrame([("1", 5, 9)], "video_id string, likes int, views int")
    tags = spark.createDataFrame([("2", "x,y")], "video_id string, tags string")
    rows = cat.with_derived(cat.catalog_join(ids, titles, lv, tags)).orderBy("video_id").collect()
    assert [(r.video_id, r.title, r.engagement_score, r.tags) for r in rows] == [("1", "a", 50.0, None), ("2", None, None, "x,y")]


def test_union_goes_by_name(spark):
    views = loading.view_events(spark.createDataFrame([("u", "v", 1704067200000)], "user_id string, video_id string, timestamp long"))
    comments = spark.createDataFrame([("u", "v", "nice")], "user_id string, video_id string, comment_content string")
    talk = loading.comment_events(comments, F.lit("2024-01-01 00:00:00").cast("timestamp")).drop("comment_length")
    talk = talk.select("user_id", "video_id", "event_type", "weight", "event_time", "completion_rate", "watch_time", "total_duration")
    both = {r.event_type: r for r in items.union_interactions(views, talk).collect()}
    assert both["comment"].watch_time is None and both["comment"].weight == 3.0
    assert 10 <= both["view"].watch_time < 70


def test_samples_are_the_same_on_every_action(spark):
    pairs = spark.range(3000).select(
        F.col("id").cast("string").alias("user_id"), F.lit("v").alias("video_id"), (F.col("id") * 1000).alias("timestamp")
    )
    views = loading.view_events(pairs)
    likes = loading.like_events(views)
    assert likes.count() == likes.count() == likes.repartition(7).count()
    eligible = views.filter("completion_rate >= 0.6").count()
    assert 0.25 < likes.count() / eligible < 0.35


def test_validate_splits_on_missing_fields(spark):
    rows = [("view", "u", "v"), (None, "u", "v"), ("view", None, "v"), ("view", "u", None)]
    valid, rejected = loading.validate(spark.createDataFrame(rows, "event_type string, user_id string, video_id string"))
    assert (valid.count(), rejected.count()) == (1, 3)


def test_upsert_keeps_other_fields(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "user_id string, n int, kept string")
    new = spark.createDataFrame([("a", 9, True), ("c", 3, False)], "user_id string, n int, extra boolean")
    rows = {tuple(r) for r in tables.upsert_by_key(old, new).collect()}
    assert rows == {("a", 9, "x", True), ("b", 2, "y", None), ("c", 3, None, False)}


def test_insert_if_absent(spark):
    held = spark.createDataFrame([("a",)], "video_id string")
    new = spark.createDataFrame([("a", 1), ("b", 3), ("b", 2), ("c", 4)], "video_id string, seq int")
    accepted, refused = tables.insert_if_absent(held, new, "video_id", "seq")
    assert {tuple(r) for r in accepted.collect()} == {("b", 2), ("c", 4)}
    assert {tuple(r) for r in refused.collect()} == {("a", 1), ("b", 3)}


def test_overwrite_and_append(spark, tmp_path):
    df = spark.range(5)
    for _ in range(2):
        tables.overwrite(df, str(tmp_path), "t")
    tables.append(df, str(tmp_path), "t")
    tables.append(df.limit(0), str(tmp_path), "t")
    assert files.collection(spark, str(tmp_path), "t").count() == 10


def test_bus_messages(spark):
    rows = spark.createDataFrame([("skip", "u1"), ("view", "u2"), ("share", "u3")], "event_type string, user_id string")
    sent = {r.key: (r.topic, r.value) for r in serving.bus_messages(rows).collect()}
    assert sent["u1"] == ("user-events", '{"event_type":"skip","user_id":"u1"}')
    assert sent["u2"][0] == "user-views" and sent["u3"][0] == "user-interactions"
