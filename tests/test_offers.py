"""What neighbours offer: by blocks as by the join, and a neighbour with very many videos sent once to a block."""

import random

import pytest
from pyspark.sql import functions as F

from clipsense.operators import items, offers, recommend

SHAPE = "user_id string, video_id string, event_type string, completion_rate double, watch_time double, weight double"


def events(spark, rows):
    return spark.createDataFrame([(*r, 20.0, 1.0) for r in rows], SHAPE)


def some(seed, users=60, videos=80, n=900):
    draw = random.Random(seed)
    return [
        (f"u{int(draw.paretovariate(0.7)) % users}", f"v{draw.randrange(videos)}", draw.choice(["like", "comment", "view", "skip"]), draw.choice([None, 0.5, 0.65, 0.9]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("kind", ["by_likes", "by_comments", "by_watch"])
def test_blocks_give_the_lists_of_the_join(spark, kind):
    rows = events(spark, some(1))
    quality = items.video_quality(items.video_stats(rows))
    make = getattr(recommend, kind)
    by_join = {(r["user_id"], r["rank"]): (r["video_id"], r["final_score"]) for r in make(rows, quality, 5, k=6).collect()}
    by_blocks = {(r["user_id"], r["rank"]): (r["video_id"], r["final_score"]) for r in make(rows, quality, 5, k=6, plain=0, user_block=7, video_block=9).collect()}
    assert by_join and by_join.keys() == by_blocks.keys()
    for key, (video, score) in by_join.items():
        assert by_blocks[key][0] == video and by_blocks[key][1] == pytest.approx(score)


def test_a_neighbour_of_everybody_is_sent_once_to_a_block(spark):
    """One user with 2,000 videos that 300 users follow: 600,000 rows by the join."""
    hot = [("hot", f"v{i}", "like", None) for i in range(2000)]
    rows = events(spark, hot + [(f"u{u:03}", f"v{u % 40}", "like", None) for u in range(300)])
    quality = items.video_quality(items.video_stats(rows))
    neighbours = spark.createDataFrame([(f"u{u:03}", "hot", 1) for u in range(300)], "user_id string, neighbour_id string, common bigint")
    assert offers.offered_rows(neighbours, rows) == 600_000
    counts = []
    found = offers.best_offers(neighbours, rows, rows, quality, recommend.likes_score, 3, plain=0, user_block=50, video_block=500, counts=counts)
    assert found.groupBy("user_id").count().filter("count = 3").count() == 300
    assert counts[0] <= 2000 * 8
    expected = offers.best_offers(neighbours, rows, rows, quality, recommend.likes_score, 3)
    key = ["user_id", "rank", "video_id", F.round("final_score", 9)]
    assert found.select(*key).exceptAll(expected.select(*key)).count() == 0


def test_nothing_to_offer(spark):
    rows = events(spark, some(2))
    quality = items.video_quality(items.video_stats(rows))
    none = spark.createDataFrame([], "user_id string, neighbour_id string, common bigint")
    for plain in (0, 10**9):
        assert offers.best_offers(none, rows, rows, quality, recommend.likes_score, 3, plain=plain).count() == 0
