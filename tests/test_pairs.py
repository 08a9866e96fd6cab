"""Products of sparse rows against brute force, with and without heavy features."""

import itertools
import math
import random
from collections import defaultdict

import pytest

from clipsense.operators import neighbours, pairs

SCHEMA = "entity string, feature string, value double"


def cells_with_hot_features(seed, entities=40, hot=3, cold=25, negative=False):
    """Hot features are held by about half of all entities each."""
    random.seed(seed)
    cells = {}
    for e in range(entities):
        for h in range(hot):
            if random.random() < 0.5:
                cells[f"e{e:02}", f"hot{h}"] = float(random.randint(1, 3))
        for _ in range(random.randint(0, 3)):
            sign = -1 if negative and random.random() < 0.3 else 1
            cells[f"e{e:02}", f"cold{random.randrange(cold)}"] = float(sign * random.randint(1, 3))
    return [(e, f, v) for (e, f), v in cells.items()]


def brute_products(rows):
    by_entity = defaultdict(dict)
    for e, f, v in rows:
        by_entity[e][f] = v
    products = {}
    for a, b in itertools.permutations(by_entity, 2):
        common = by_entity[a].keys() & by_entity[b].keys()
        if common:
            products[a, b] = sum(by_entity[a][f] * by_entity[b][f] for f in common)
    return by_entity, products


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("limit", [4, 1000])
def test_top_partners_equals_brute_force(spark, seed, limit):
    rows = cells_with_hot_features(seed)
    _, products = brute_products(rows)
    expected = set()
    for e in {a for a, _ in products}:
        ranked = sorted(((-p, b) for (a, b), p in products.items() if a == e))[:5]
        expected |= {(e, b, -p, i + 1) for i, (p, b) in enumerate(ranked)}
    found = pairs.top_partners(spark.createDataFrame(rows, SCHEMA), 5, limit, block_entities=7)
    assert {(r["left"], r["right"], r["product"], r["rank"]) for r in found.collect()} == expected


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("limit", [4, 1000])
def test_similar_pairs_equals_brute_force(spark, seed, limit):
    rows = cells_with_hot_features(seed, negative=True)
    by_entity, products = brute_products(rows)
    norm = {e: math.sqrt(sum(v * v for v in fs.values())) for e, fs in by_entity.items()}
    cosines = {(a, b): p / norm[a] / norm[b] for (a, b), p in products.items() if a < b}
    assert all(abs(c - 0.35) > 1e-6 for c in cosines.values())
    expected = {k for k, c in cosines.items() if c >= 0.35}
    unit = pairs.unit_cells(spark.createDataFrame(rows, SCHEMA))
    found = pairs.similar_pairs(unit, 0.35, limit, block_entities=7).collect()
    assert len(found) == len({(r["left"], r["right"]) for r in found})
    assert {(r["left"], r["right"]) for r in found} == expected
    for row in found:
        assert row["product"] == pytest.approx(cosines[row["left"], row["right"]])


@pytest.mark.parametrize("large", [10_000, 2])
def test_similar_pairs_by_bounds(spark, monkeypatch, large):
    """Pairs are looked for by bounds; large entities go in parts, null and zero cells give nothing."""
    monkeypatch.setattr(pairs, "PLAIN_PAIRS", 0)
    monkeypatch.setattr(pairs, "LARGE", large)
    random.seed(5)
    rows = {(f"e{random.randrange(60):02}", f"f{int(random.paretovariate(0.7)) % 40}"): random.choice([-2.0, 0.0, 1.0, 3.0, 40.0]) for _ in range(500)}
    rows = [(e, f, v) for (e, f), v in rows.items()] + [("e00", None, 2.0), (None, "f1", 2.0), ("e01", "f99", None)]
    unit = pairs.unit_cells(spark.createDataFrame(rows, SCHEMA)).cache()
    _, products = brute_products([tuple(r) for r in unit.collect() if r["feature"] is not None and r["value"] is not None])
    expected = {k: p for k, p in products.items() if k[0] < k[1] and p >= 0.3}
    found = pairs.similar_pairs(unit, 0.3, 1000).collect()
    assert len(found) == len(expected) > 100
    assert {(r["left"], r["right"]): r["product"] for r in found} == pytest.approx(expected)


def test_only_close_pairs_go_on(spark, monkeypatch):
    """Without a heavy feature no join makes a row for each pair, and what goes on are the pairs that are close."""
    rows = [(f"e{i:03}", f"f{f}", 1.0) for i in range(400) for f in random.Random(i // 2).sample(range(60), 8)]
    cells = pairs.staged(pairs.unit_cells(spark.createDataFrame(rows, SCHEMA)))
    sizes = pairs.staged(cells.groupBy("entity").count().toDF("entity", "cells"))
    likely = {tuple(sorted(r)) for r in pairs.likely_pairs(cells, sizes, 0.45, 4).collect()}
    monkeypatch.setattr(pairs, "PLAIN_PAIRS", 0)
    monkeypatch.setattr(pairs, "light_products", None)
    found = {(r["left"], r["right"]) for r in pairs.similar_pairs(cells, 0.45, 1000).collect()}
    assert {(f"e{i:03}", f"e{i + 1:03}") for i in range(0, 400, 2)} <= found <= likely
    assert len(likely) < 1.2 * len(found) + 50


@pytest.mark.parametrize("limit", [4, 1000])
def test_all_products_equals_brute_force(spark, limit):
    rows = cells_with_hot_features(7)
    _, products = brute_products(rows)
    found = pairs.all_products(spark.createDataFrame(rows, SCHEMA), limit, block_entities=7)
    assert {(r["left"], r["right"]): r["product"] for r in found.collect()} == products


def test_one_feature_held_by_everybody(spark):
    """Equal entities collapse: each gets the smallest other ids."""
    rows = [(f"e{i:03}", "all", 1.0) for i in range(60)]
    found = pairs.top_partners(spark.createDataFrame(rows, SCHEMA), 2, limit=10, block_entities=8)
    got = defaultdict(list)
    for r in found.orderBy("left", "rank").collect():
        got[r["left"]].append(r["right"])
    assert len(got) == 60
    assert got["e000"] == ["e001", "e002"]
    assert got["e001"] == ["e000", "e002"]
    assert got["e059"] == ["e000", "e001"]


def test_front_of_each_group_is_enough(spark):
    """Few offers per group of equals reach the block step, whatever its size."""
    rows = [(f"e{i:04}", "all", 1.0) for i in range(500)] + [(f"e{i:04}", "other", 2.0) for i in range(0, 500, 2)]
    found = pairs.top_partners(spark.createDataFrame(rows, SCHEMA), 3, limit=20, block_entities=50)
    best = {(r["left"], r["rank"]): (r["right"], r["product"]) for r in found.collect()}
    assert best["e0000", 1] == ("e0002", 5.0)
    assert best["e0001", 1] == ("e0000", 1.0)
    assert best["e0499", 3] == ("e0002", 1.0)
    assert len(best) == 1500


def test_repeats_multiply_unless_distinct(spark):
    rows = [("a", "v"), ("a", "v"), ("b", "v"), ("b", "v"), ("b", "v"), ("c", "w")]
    likes = spark.createDataFrame(rows, "user_id string, video_id string")
    bag = {(r.user_id, r.neighbour_id): r.common for r in neighbours.top_neighbours(likes, 10).collect()}
    once = {(r.user_id, r.neighbour_id): r.common for r in neighbours.top_neighbours(likes, 10, distinct=True).collect()}
    assert bag == {("a", "b"): 6, ("b", "a"): 6}
    assert once == {("a", "b"): 1, ("b", "a"): 1}


def test_settled_entities_do_not_ask(spark):
    """A strong light partner settles an entity; a weak one does not."""
    rows = [(f"e{i:02}", "hot", 1.0) for i in range(20)]
    rows += [("e00", "cold", 3.0), ("e01", "cold", 3.0), ("e02", "mild", 0.1), ("e03", "mild", 0.1)]
    cells = spark.createDataFrame(rows, SCHEMA)
    light, heavy, tasks = pairs.split_by_holders(cells, 10)
    known = pairs.vectors(heavy)
    ranked = pairs.top_per_key(pairs.both_ways(pairs.light_products(light, tasks)), "left", ["product"], 1)
    asking = {r.entity for r in pairs._unsettled(ranked, heavy, 1).collect()}
    assert "e00" not in asking and "e01" not in asking and {"e02", "e03", "e19"} <= asking
    assert known.count() == 20
    best = {r["left"]: (r["right"], r["product"]) for r in pairs.top_partners(cells, 1, 10).collect()}
    assert best["e00"] == ("e01", 10.0) and best["e02"] == ("e03", pytest.approx(1.01)) and best["e19"] == ("e00", 1.0)
