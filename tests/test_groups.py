"""Entities with the same cells: joined once, and their users' lists made from one list of neighbours."""

import random

import pytest

from clipsense.operators import items, offers, pairs, recommend

CELLS = "entity string, feature string, value double"
EVENTS = "user_id string, video_id string, event_type string, completion_rate double, watch_time double, weight double"


def test_entities_with_the_same_cells_are_joined_once(spark, monkeypatch):
    kinds = [{"a": 1.0}, {"a": 1.0, "b": 2.0}, {"b": 1.0, "c": 1.0}, {"d": 3.0}, {"a": 2.0}]
    held = {f"e{i:03}": kinds[i * i % 5] if i < 190 else {"a": 1.0 + i, "d": 2.0} for i in range(200)}
    held["e003"] = {"d": 3.0}
    rows = [(e, f, v) for e, cells in held.items() for f, v in cells.items()]
    joined, plain = [], pairs.light_products

    def watched(cells, tasks):
        joined.append(cells.select("entity").distinct().count())
        return plain(cells, tasks)

    monkeypatch.setattr(pairs, "light_products", watched)
    found = {(r["left"], r["rank"]): (r["right"], r["product"]) for r in pairs.top_partners(spark.createDataFrame([*rows, (None, "a", 1.0), ("e001", None, 1.0)], CELLS), 5).collect()}
    expected = {}
    for left, mine in held.items():
        products = [(sum(v * cells.get(f, 0.0) for f, v in mine.items()), right) for right, cells in held.items() if right != left]
        best = sorted((-p, right) for p, right in products if p > 0)[:5]
        expected.update({(left, i + 1): (right, -p) for i, (p, right) in enumerate(best)})
    assert found == expected
    assert max(joined) <= 15


def test_repeated_cells_are_no_other_cells(spark):
    rows = [(e, f, 1.0) for e, f in [("p", "a"), ("q", "b"), ("r", "a"), ("s", "b")] for _ in range(2)]
    found = pairs.top_partners(spark.createDataFrame(rows, CELLS), 3).collect()
    assert {(r["left"], r["right"]) for r in found} == {("p", "r"), ("r", "p"), ("q", "s"), ("s", "q")}


@pytest.mark.parametrize("kind", ["by_likes", "by_comments", "by_watch"])
def test_lists_of_groups_are_those_of_each_user(spark, monkeypatch, kind):
    draw = random.Random(4)
    rows = []
    for u in range(150):
        alike = [f"v{u % 3}"] if u % 4 else [f"v{u % 3}", "v3"]
        rows += [(f"u{u:03}", v, t, c) for v in alike for t, c in (("like", None), ("comment", None), ("view", 0.9))]
        rows += [(f"u{u:03}", f"v{draw.randrange(25)}", draw.choice(["skip", "view"]), draw.choice([None, 0.1, 0.65])) for _ in range(draw.randrange(9))]
    rows += [(f"w{u}", f"v{draw.randrange(25)}", t, 0.8) for u in range(15) for t in ("like", "comment", "view") for _ in range(6)]
    rows.append((None, "v1", "like", None))
    events = spark.createDataFrame([(*r, 20.0, 1.0) for r in rows], EVENTS)
    quality = items.video_quality(items.video_stats(events))
    asked, plain = [], offers.candidates

    def watched(neighbours, offered):
        asked.append(neighbours.select("user_id").distinct().count())
        return plain(neighbours, offered)

    monkeypatch.setattr(offers, "candidates", watched)

    def lists(**settings):
        found = getattr(recommend, kind)(events, quality, 4, k=12, **settings).collect()
        return {(r["user_id"], r["rank"]): (r["video_id"], round(r["final_score"], 9)) for r in found}

    by_group = lists()
    assert asked and max(asked) <= 80
    by_block = lists(plain=0, user_block=7, video_block=9)
    small_blocks = lists(group_users=10)
    monkeypatch.setattr(pairs, "ALIKE", 10**9)
    each = lists()
    assert each and by_group == each and by_block == each and small_blocks == each
