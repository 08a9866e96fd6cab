"""Profiles, idle timers, serving tiers, content lists."""

import random

import pytest
from pyspark.sql import functions as F

from clipsense.ml.ids import id_index
from clipsense.operators import items, profiles, recency, recommend, serving

EVENT = "user_id string, video_id string, event_type string, event_time string, weight double, watch_time double, completion_rate double"


def events(spark, rows):
    return spark.createDataFrame(rows, EVENT).withColumn("event_time", F.col("event_time").cast("timestamp"))


def at(text):
    return F.lit(text).cast("timestamp")


def test_active_days_use_real_time(spark):
    rows = [("u", "1", "view", "2024-01-01 23:00:00", 5.0, 60.0, 1.0), ("u", "2", "view", "2024-01-04 01:00:00", 5.0, 30.0, 0.5)]
    catalog = spark.createDataFrame([("1", "a,b"), ("2", "a,b")], "video_id string, tags string")
    row = profiles.full_user_profile(events(spark, rows), catalog).first()
    assert (row.active_days, row.avg_watch_time, row.unique_categories, row.unique_videos_watched) == (4, 45.0, 1, 2)


def test_tag_parts_keep_blanks_unless_trimmed(spark):
    rows = [("u", "1", "view", "2024-01-01", 1.0, 1.0, 1.0), ("u", "2", "like", "2024-01-01", 1.0, None, None)]
    catalog = spark.createDataFrame([("1", "a, b"), ("2", "b")], "video_id string, tags string")
    as_given = {(r.tag, r.tag_count) for r in profiles.tag_counts(events(spark, rows), catalog).collect()}
    trimmed = {(r.tag, r.tag_count) for r in profiles.tag_counts(events(spark, rows), catalog, trim_tags=True).collect()}
    assert as_given == {("a", 1), (" b", 1), ("b", 1)} and trimmed == {("a", 1), ("b", 2)}


def test_null_scores_rank_last_and_lists_are_in_order(spark):
    affinity = spark.createDataFrame([("u", "x", None), ("u", "y", 1.0), ("u", "z", 3.0)], "user_id string, tags string, tags_score double")
    row = profiles.as_list(profiles.top_tags(affinity), "tops", "tags").first()
    assert [t.tags for t in row.tops] == ["z", "y", "x"]


def test_timer_edges(spark):
    """A pause of exactly the timer keeps the key; one second more drops it."""
    for pause, kept in (("2024-01-02 23:59:59", 2), ("2024-01-03 00:00:00", 2), ("2024-01-03 00:00:01", 1)):
        rows = [("u", "1", "view", "2024-01-02 00:00:00", 5.0, None, None), ("u", "2", "like", pause, 10.0, None, None)]
        scores = recency.recent_video_scores(events(spark, rows), at("2024-01-03 12:00:00"))
        assert scores.count() == kept, pause


def test_dead_keys_give_nothing_and_last_write_wins(spark):
    rows = [
        ("u", "1", "like", "2024-01-01 00:00:00", 10.0, None, None),
        ("u", "1", "skip", "2024-01-01 01:00:00", -2.0, None, None),
        ("old", "1", "like", "2023-12-01 00:00:00", 10.0, None, None),
    ]
    scores = recency.recent_video_scores(events(spark, rows), at("2024-01-01 02:00:00")).collect()
    assert [(r.user_id, r.video_id, r.score) for r in scores] == [("u", "1", -2.0)]
    later = recency.recent_video_scores(events(spark, rows), at("2024-01-05 00:00:00"))
    assert later.count() == 0


def test_counters_restart_after_a_pause(spark):
    rows = [
        ("u", "1", "view", "2024-01-01 00:00:00", 1.0, None, None),
        ("u", "1", "view", "2024-01-01 02:00:00", 1.0, None, None),
        ("w", "1", "like", "2024-01-01 02:30:00", 1.0, None, None),
    ]
    found = recency.video_counters(events(spark, rows), at("2024-01-01 03:00:00"), ttl=3600).collect()
    assert {(r.event_type, r.events) for r in found} == {("view", 1), ("like", 1)}


def test_sessions_match_brute_force(spark):
    random.seed(5)
    times = {u: sorted(random.sample(range(0, 200_000), 60)) for u in ("a", "b")}
    rows = [(u, str(i), "view", f"{x}", 1.0, 1.0, 1.0) for u, xs in times.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, EVENT).withColumn("event_time", F.timestamp_seconds(F.col("event_time").cast("bigint")))
    expected = set()
    for user, xs in times.items():
        session = [xs[0]]
        for x in xs[1:] + [10**9]:
            if x - session[-1] > 1800:
                expected.add((user, session[0], len(session), float(session[-1] - session[0])))
                session = []
            session.append(x)
    found = recency.sessions(df).select("user_id", F.unix_seconds("started_at"), "events", "duration_seconds")
    assert {tuple(r) for r in found.collect()} == expected


def test_recent_videos_are_the_last_ones(spark):
    rows = [("u", str(i), "view", f"2024-01-01 00:{i:02}:00", 1.0, None, None) for i in range(10)]
    found = recency.recent_videos(events(spark, rows), n=3).orderBy("pos").collect()
    assert [r.video_id for r in found] == ["7", "8", "9"]


def test_trending_uses_time_and_breaks_ties_by_id(spark):
    rows = [("u", v, "like", "2024-01-02 00:00:00", 10.0, None, None) for v in ("b", "a")]
    rows += [("u", "c", "share", "2023-12-31 00:00:00", 99.0, None, None)]
    found = items.trending(events(spark, rows), at("2024-01-02 01:00:00")).collect()
    assert [(r.video_id, r.rank) for r in found] == [("a", 1), ("b", 2)]


def test_serving_takes_the_first_tier_with_rows(spark):
    users = spark.createDataFrame([("a",), ("b",), ("new",)], "user_id string")
    rec = "user_id string, video_id string, score double"
    stored = spark.createDataFrame([("a", "1", 1.0), ("gone", "1", 1.0)], rec)
    cached = spark.createDataFrame([("a", "2", 9.0), ("b", "3", 2.0)], rec)
    hot = spark.createDataFrame([("7", 5.0), ("8", 6.0)], "video_id string, score double")
    rows = serving.first_tier(users, [("stored", stored), ("cached", cached)], [("none", hot.filter("false")), ("trending", hot)]).collect()
    assert {(r.user_id, r.video_id, r.method, r.rank) for r in rows} == {
        ("a", "1", "stored", 1), ("b", "3", "cached", 1), ("new", "8", "trending", 1), ("new", "7", "trending", 2),
    }


@pytest.mark.parametrize("limit", [3, 15, 1000])
def test_content_lists_equal_brute_force(spark, limit):
    """Many items share one tag string, and users have seen the first of them."""
    random.seed(11)
    tags = ["a", "b", "c", "a,b", "b,c", "a,rare1", "b,rare2,c", "rare1"]
    catalog = [(f"{i:03}", "a,b" if i % 3 else random.choice(tags)) for i in range(120)]
    seen = {("u1", f"{i:03}") for i in range(30)} | {("u2", f"{random.randrange(120):03}") for _ in range(40)}
    prefs = [("u1", "a", 5), ("u1", "c", 2), ("u2", "b", 3), ("u2", "c", 3), ("u2", "rare2", 1), ("u1", "rare1", 3), ("u3", "zzz", 1)]
    expected = set()
    for user in ("u1", "u2", "u3"):
        mine = {t: n for u, t, n in prefs if u == user}
        scores = [(-sum(mine.get(t, 0) for t in set(ts.split(","))), v) for v, ts in catalog if (user, v) not in seen]
        ranked = sorted(s for s in scores if s[0] < 0)[:8]
        expected |= {(user, v, -s, i + 1) for i, (s, v) in enumerate(ranked)}
    found = recommend.by_content(
        spark.createDataFrame(prefs, "user_id string, tag string, tag_count long"),
        spark.createDataFrame(list(seen), "user_id string, video_id string"),
        spark.createDataFrame(catalog, "video_id string, tags string"), n=8, limit=limit,
    )
    assert {(r.user_id, r.video_id, r.score, r["rank"]) for r in found.collect()} == expected


def test_one_shared_video_is_enough_for_watch_neighbours(spark):
    rows = [("u", "1", "view", "2024-01-01", 5.0, 60.0, 0.9), ("w", "1", "view", "2024-01-01", 5.0, 60.0, 0.7), ("w", "2", "view", "2024-01-01", 3.0, 36.0, 0.6)]
    ix = events(spark, rows)
    q = items.video_quality(items.video_stats(ix))
    found = recommend.by_watch(ix, q).collect()
    assert [(r.user_id, r.video_id) for r in found] == [("u", "2")]
    quality = {r.video_id: r.quality_score for r in q.collect()}["2"]
    assert abs(found[0].final_score - (0.5 + 0.6 * 30 + quality * 0.3)) < 1e-9


def test_ids_are_dense_and_stable(spark):
    df = spark.range(5000).select(F.concat(F.lit("user_"), "id").alias("user_id"))
    first = {r.user_id: r.idx for r in id_index(df, "user_id", "idx").collect()}
    again = {r.user_id: r.idx for r in id_index(df.repartition(9), "user_id", "idx").collect()}
    assert first == again and sorted(first.values()) == list(range(5000))


def test_sparsity_of_repeated_pairs(spark):
    rows = [("u", "1", "view", "2024-01-01", 1.0, None, None)] * 3
    row = items.sparsity(events(spark, rows)).first()
    assert (row.sparsity, row.pair_sparsity) == (-2.0, 0.0)


def test_mixed_lists_are_scaled_per_user(spark):
    rec = "user_id string, video_id string, score double"
    a = spark.createDataFrame([("u", "1", 10.0), ("u", "2", 0.0)], rec)
    b = spark.createDataFrame([("u", "2", 7.0)], rec)
    rows = {r.video_id: (r.score, r.methods) for r in recommend.mixed({"als": (a, 0.6), "item_cf": (b, 0.4)}).collect()}
    assert rows == {"1": (0.6, ["als"]), "2": (0.4, ["als", "item_cf"])}
