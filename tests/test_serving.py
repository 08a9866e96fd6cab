"""Shared lists and lists of a category reach users and items in order, without a sort of what they become."""

import random

from clipsense.operators import serving


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_shared_lists_of_repeated_and_null_users(spark):
    """Users with lists of their own, users given twice, null users, ties and null scores."""
    own = spark.createDataFrame([("u1", "v9", 1.0), ("u1", "v8", 1.0)], "user_id string, video_id string, score double")
    hot = spark.createDataFrame([(f"v{i}", None if i == 6 else float(i // 2)) for i in range(7)], "video_id string, score double")
    users = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("u3",), (None,), (None,), (None,)], "user_id string")
    listed = [f"v{i}" for i in sorted(range(6), key=lambda i: (-(i // 2), i))] + ["v6"]
    found = {}
    for row in serving.first_tier(users, [("own", own)], [("none", hot.filter("false")), ("hot", hot)], 10).collect():
        found.setdefault(row["user_id"], []).append((row["rank"], row["video_id"], row["method"]))
    expected = {"u1": [(1, "v8", "own"), (2, "v9", "own")]}
    for user, times in (("u2", 1), ("u3", 2), (None, 3)):
        expected[user] = [(i + 1, v, "hot") for i, v in enumerate([v for v in listed for _ in range(times)][:10])]
    assert {u: sorted(rows) for u, rows in found.items()} == expected


def test_shared_lists_are_not_sorted_by_user(spark):
    """The window over the users has their own rows only, the lists are put in order before they reach a user."""
    none = spark.createDataFrame([], "user_id string, video_id string, score double")
    hot = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "video_id string, score double")
    users = spark.range(1000).selectExpr("CAST(id AS STRING) AS user_id")
    told = plan(serving.first_tier(users, [("own", none)], [("hot", hot)]))
    below, depth = [], None
    for line in told.split("\n"):
        at = len(line) - len(line.lstrip(" :+-"))
        depth = None if depth is not None and at <= depth else depth
        if depth is None and "Window [row_number" in line and "user_id" in line:
            depth = at
        elif depth is not None:
            below.append(line)
    assert "Generate explode" in told and not any("Generate explode" in line for line in below)


def test_items_of_a_category(spark):
    """Against a sort of all pairs: items given twice, of two categories, of none, and null scores."""
    draw = random.Random(5)
    rows = [(f"v{i:02}", draw.choice("abc"), draw.choice([None, 1.0, 2.0, 3.0])) for i in range(40)]
    rows += [rows[3], ("v05", "a", 2.0), ("v05", "b", 1.0), ("v90", None, 1.0), ("v91", "alone", 1.0)]
    schema = "video_id string, category string, engagement_score double"
    new = [r for r in rows if r[0] in ("v01", "v03", "v05", "v07", "v90", "v91")] + [rows[7], (None, "a", 1.0)]
    score = lambda r: (r[2] is None, -(r[2] or 0.0), r[0])
    expected = []
    for item in {r[0] for r in new if r[0]}:
        mine = [o for r in new if r[0] == item and r[1] for o in sorted((x for x in rows if x[1] == r[1]), key=score)[:5] if o[0] != item]
        expected += [(item, o[0], o[2], i + 1) for i, o in enumerate(sorted(mine, key=score)[:4])]
    found = serving.similar_in_category(spark.createDataFrame(new, schema), spark.createDataFrame(rows, schema), 4)
    key = lambda r: (r[0], r[3])
    assert sorted(((r["video_id"], r["similar_id"], r["score"], r["rank"]) for r in found.collect()), key=key) == sorted(expected, key=key)
