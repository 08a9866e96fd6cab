"""Content lists: how often the rows of users and tag groups are sent."""

import re

from clipsense.operators import recommend

CATALOG = [("v1", "a,b"), ("v2", "a,b"), ("v3", "a,c"), ("v4", "b,c"), ("v5", "c")]


def test_scores_of_groups_are_sent_once_and_by_user(spark):
    """Prepared by user, they were sent by user and group, once to be summed and once to meet what is seen."""
    prefs = spark.createDataFrame([("u", "a", 2), ("u", "b", 1), (None, "c", 1)], "user_id string, tag string, tag_count bigint").repartition(4, "user_id")
    seen = spark.createDataFrame([("u", "v1"), (None, "v5")], "user_id string, video_id string")
    found = recommend.by_content(prefs, seen, spark.createDataFrame(CATALOG, "video_id string, tags string"), n=2, limit=1)
    rows = sorted(((r.user_id, r["rank"], r.video_id, r.score) for r in found.collect()), key=str)
    assert rows == [("u", 1, "v2", 3), ("u", 2, "v3", 2), (None, 1, "v3", 1), (None, 2, "v4", 1)]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert not re.search(r"\[user_id#\d+, tags#\d+\], \[user_id#\d+, tags#\d+\], LeftOuter", plan)


def test_items_that_no_list_can_show_are_cut_before_they_are_sent(spark):
    """Groups of equal score gave n items each."""
    tags = [("v%d" % i, "a,%s" % "bcde"[i % 4]) for i in range(40)]
    prefs = spark.createDataFrame([("u", "a", 2)], "user_id string, tag string, tag_count bigint")
    seen = spark.createDataFrame([("u", "v0"), ("u", "v1"), ("u", "w")], "user_id string, video_id string")
    items = spark.createDataFrame(tags, "video_id string, tags string")
    found = recommend._first_of_groups(prefs.withColumnRenamed("tag", "feature"), items, seen, 3).collect()
    # In order v0, v1, v10, v11, v12: three, and as many as were seen of the groups.
    assert sorted(r.video_id for r in found) == ["v0", "v1", "v10", "v11", "v12"]
