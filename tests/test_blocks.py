"""Inner products by blocks: exact results, and that most blocks are left out where data are skewed."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipsense.ml import als, similarity
from clipsense.operators import blocks, pairs
from clipsense.session import staged

SCHEMA = "id string, index array<bigint>, value array<double>"
CELLS = "entity string, feature string, value double"


def table(spark, dense):
    """Rows of a matrix as vectors, zeros left out."""
    rows = [(f"i{k:04}", [int(f) for f in np.flatnonzero(row)], [float(row[f]) for f in np.flatnonzero(row)]) for k, row in enumerate(dense)]
    return staged(spark.createDataFrame(rows, SCHEMA))


def top_by_hand(dense, k, positive=True):
    products, names = dense @ dense.T, [f"i{j:04}" for j in range(len(dense))]
    found = set()
    for i in range(len(dense)):
        order = sorted((-products[i, j], names[j]) for j in range(len(dense)) if j != i and (products[i, j] > 0 or not positive))[:k]
        found |= {(names[i], name, round(-p, 9), place + 1) for place, (p, name) in enumerate(order)}
    return found


def told(df):
    return {(r["left"], r["right"], round(r["product"], 9), r["rank"]) for r in df.collect()}


def matrix(seed, n=90, features=40, share=0.1, signed=False):
    draw = np.random.default_rng(seed)
    dense = draw.integers(1, 4, (n, features)) * (draw.random((n, features)) < share)
    return dense * draw.choice([-1.0, 1.0], dense.shape) if signed else dense.astype(float)


@pytest.mark.parametrize("signed", [False, True])
@pytest.mark.parametrize("features", [3, 1024])
def test_top_products_equal_brute_force(spark, signed, features):
    """Also where features share cells of the summary."""
    dense = matrix(1, signed=signed)
    vectors = table(spark, dense)
    for positive in (True, False):
        found = blocks.top_products(vectors, blocks.arrange(vectors, 8, features), 4, positive=positive)
        assert told(found) == top_by_hand(dense, 4, positive)


@pytest.mark.parametrize("slice_rows, chunk", [(1, 1), (7, 20), (1024, 16384)])
def test_cuts_do_not_matter(spark, monkeypatch, slice_rows, chunk):
    monkeypatch.setattr(blocks, "SLICE", slice_rows)
    monkeypatch.setattr(blocks, "CHUNK", chunk)
    monkeypatch.setattr(blocks, "FEATURES", 5)
    dense = matrix(2)
    vectors = table(spark, dense)
    assert told(blocks.top_products(vectors, blocks.arrange(vectors, 10), 3)) == top_by_hand(dense, 3)


def test_floors_are_kept(spark):
    dense = matrix(3)
    vectors = table(spark, dense)
    found = blocks.top_products(vectors.withColumn("floor", F.lit(8.0)), blocks.arrange(vectors, 8), 50)
    assert {r["left"] + r["right"] for r in found.collect()} == {a + b for a, b, p, _ in top_by_hand(dense, 100) if p >= 8}


@pytest.mark.parametrize("signed", [False, True])
def test_products_from_equal_brute_force(spark, signed):
    dense = matrix(4, signed=signed)
    vectors = table(spark, dense)
    products = dense @ dense.T
    for threshold in (0.0, 5.0):
        found = {(r["left"], r["right"]): r["product"] for r in blocks.products_from(blocks.arrange(vectors, 8), threshold).collect()}
        assert found == {(f"i{i:04}", f"i{j:04}"): products[i, j] for i in range(90) for j in range(i + 1, 90) if products[i, j] > 0 and products[i, j] >= threshold}


def test_empty_and_single(spark):
    none = table(spark, np.zeros((0, 3)))
    assert blocks.top_products(none, blocks.arrange(none), 3).count() == 0
    assert blocks.products_from(blocks.arrange(none), 0.5).count() == 0
    one = table(spark, np.ones((1, 3)))
    assert blocks.top_products(one, blocks.arrange(one), 3).count() == 0


def test_dense_vectors(spark):
    """Vectors without an index have all features, and equal products go by id."""
    dense = np.random.default_rng(8).integers(0, 3, (70, 6)).astype(float)
    vectors = table(spark, dense + 0.0)
    rows = staged(spark.createDataFrame([(f"i{k:04}", row.tolist()) for k, row in enumerate(dense)], "id string, value array<float>"))
    found = told(blocks.top_products(rows, blocks.arrange(rows, 9, features=6), 4))
    assert found == top_by_hand(dense, 4) == told(blocks.top_products(vectors, blocks.arrange(vectors, 9), 4))


def clusters(seed, groups=30, size=40, features=6):
    """Groups of vectors with features of their own, some much longer than others, and two features of everybody."""
    draw = np.random.default_rng(seed)
    dense = np.zeros((groups * size, groups * features + 2))
    for g in range(groups):
        rows = slice(g * size, (g + 1) * size)
        dense[rows, g * features : (g + 1) * features] = draw.random((size, features)) * (1 + 10 * (g % 5 == 0))
        dense[rows, -2:] = 0.05 * draw.random((size, 2))
    return dense


def test_most_blocks_are_left_out(spark):
    dense = clusters(5)
    vectors = table(spark, dense)
    laid = blocks.arrange(vectors, 40)
    every = len(dense) * len(laid.summary.blocks)
    counts = []
    assert told(blocks.top_products(vectors, laid, 5, counts=counts)) == top_by_hand(dense, 5)
    assert sum(counts) < 0.15 * every
    counts = []
    unit = dense / np.sqrt((dense**2).sum(axis=1, keepdims=True))
    vectors = table(spark, unit)
    found = blocks.products_from(blocks.arrange(vectors, 40), 0.8, counts)
    products = unit @ unit.T
    assert found.count() == int((np.triu(products, 1) >= 0.8).sum())
    assert sum(counts) < 0.15 * every


def test_summary_does_not_grow_with_the_data(spark, monkeypatch):
    """More rows make larger blocks, once the summary is full."""
    monkeypatch.setattr(blocks, "SUMMARY_CELLS", 64)
    vectors = table(spark, matrix(6))
    laid = blocks.arrange(vectors, 2, features=8)
    assert laid.summary.most.size <= 64
    assert told(blocks.top_products(vectors, laid, 3)) == top_by_hand(matrix(6), 3)


def hot_cells(groups=12, size=60):
    """Each group shares a feature that is heavy; one feature is everybody's."""
    draw = random.Random(7)
    cells = []
    for e in range(groups * size):
        name = f"e{e:04}"
        cells += [(name, f"g{e // size}", float(draw.randint(3, 9))), (name, "all", 1.0)]
        cells += [(name, f"c{e // size}-{draw.randrange(40)}", 1.0) for _ in range(1)]
    return sorted({(e, f): v for e, f, v in cells}.items()), groups * size


def test_partners_meet_few_blocks_of_hot_features(spark):
    cells, n = hot_cells()
    rows = [(e, f, v) for (e, f), v in cells]
    by_entity = {}
    for e, f, v in rows:
        by_entity.setdefault(e, {})[f] = v
    counts = []
    found = pairs.top_partners(spark.createDataFrame(rows, CELLS), 5, limit=20, block_entities=20, counts=counts)
    got = {}
    for r in found.collect():
        got.setdefault(r["left"], []).append((-r["product"], r["right"]))
    for e in random.Random(1).sample(sorted(by_entity), 60):
        expected = sorted((-sum(v * by_entity[o].get(f, 0) for f, v in by_entity[e].items()), o) for o in by_entity if o != e)[:5]
        assert sorted(got[e]) == expected
    kinds = sum(counts)
    assert counts and kinds < 0.3 * n * (n / 20)


def test_common_cells_stay_out_of_the_join(spark):
    """The feature of everybody is in no vector's join, and heavy only for those that hold nothing else."""
    rows = [(f"e{i:03}", "all", 1.0) for i in range(200)] + [(f"e{i:03}", f"own{i // 2}", 3.0) for i in range(190)]
    cells = pairs.unit_cells(spark.createDataFrame(rows, CELLS))
    steps = pairs.graded(cells, 2**62)
    outside = {r["entity"]: r["outside"] for r in pairs.left_out(steps, F.col("value") * F.col("value"), F.lit(0.25)).collect()}
    assert all((outside[f"e{i:03}"] > 0) == (i < 190) for i in range(200))
    found = {(r["left"], r["right"]): r["product"] for r in pairs.similar_pairs(cells, 0.5, limit=5, block_entities=4).collect()}
    expected = {(f"e{i:03}", f"e{i + 1:03}"): 1.0 for i in range(0, 190, 2)}
    expected |= {(f"e{i:03}", f"e{j:03}"): 1.0 for i in range(190, 200) for j in range(i + 1, 200)}
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(v) for k, v in expected.items())


@pytest.mark.parametrize("seed, limit, threshold", [(0, 2, 0.2), (1, 6, 0.6), (2, 1000, 0.6), (3, 6, 0.95)])
def test_similar_pairs_at_all_limits(spark, monkeypatch, seed, limit, threshold):
    monkeypatch.setattr(pairs, "PLAIN_PAIRS", 0)
    draw = random.Random(seed)
    cells = {(f"e{e:02}", f"f{int(draw.paretovariate(0.6)) % 30}"): draw.choice([-1, 1, 2, 3]) * 1.0 for e in range(50) for _ in range(draw.randint(1, 8))}
    names = sorted({e for e, _ in cells})
    features = sorted({f for _, f in cells})
    dense = np.array([[cells.get((e, f), 0.0) for f in features] for e in names])
    dense /= np.sqrt((dense**2).sum(axis=1, keepdims=True))
    products = dense @ dense.T
    expected = {(names[i], names[j]) for i in range(len(names)) for j in range(i + 1, len(names)) if products[i, j] >= threshold}
    close = {(names[i], names[j]) for i in range(len(names)) for j in range(i + 1, len(names)) if abs(products[i, j] - threshold) < 1e-9}
    unit = pairs.unit_cells(spark.createDataFrame([(e, f, v) for (e, f), v in cells.items()], CELLS))
    found = {(r["left"], r["right"]) for r in pairs.similar_pairs(unit, threshold, limit, block_entities=6).collect()}
    assert found ^ expected <= close


@pytest.mark.parametrize("seed, limit, rare", [(0, 2, 1), (1, 6, 4), (2, 40, 32), (3, 1000, 4)])
def test_partners_at_all_limits(spark, monkeypatch, seed, limit, rare):
    monkeypatch.setattr(pairs, "RARE_HOLDERS", rare)
    monkeypatch.setattr(pairs, "PLAIN_PAIRS", 0)
    draw = random.Random(seed)
    cells = {(f"e{e:02}", f"f{int(draw.paretovariate(0.6)) % 30}"): float(draw.randint(1, 5)) for e in range(60) for _ in range(draw.randint(1, 8))}
    names, features = sorted({e for e, _ in cells}), sorted({f for _, f in cells})
    products = (lambda m: m @ m.T)(np.array([[cells.get((e, f), 0.0) for f in features] for e in names]))
    expected = set()
    for i, e in enumerate(names):
        best = sorted((-products[i, j], names[j]) for j in range(len(names)) if j != i and products[i, j] > 0)[:2]
        expected |= {(e, o, -p, place + 1) for place, (p, o) in enumerate(best)}
    found = pairs.top_partners(spark.createDataFrame([(e, f, v) for (e, f), v in cells.items()], CELLS), 2, limit, block_entities=6)
    assert {(r["left"], r["right"], r["product"], r["rank"]) for r in found.collect()} == expected


@pytest.fixture(scope="module")
def tastes(spark):
    """Users and items of eight tastes, a few items seen by very many."""
    draw = random.Random(4)
    rows = {}
    for u in range(240):
        for _ in range(25):
            item = draw.randrange(8) if draw.random() < 0.2 else 8 * draw.randrange(1, 100) + u % 8
            rows[f"u{u}", f"v{item}"] = float(draw.randint(1, 9))
    return als.train(spark.createDataFrame([(u, v, w) for (u, v), w in rows.items()], "user_id string, video_id string, weight double"), rank=16, maxIter=8)


def test_lists_are_those_of_the_library(tastes, monkeypatch):
    monkeypatch.setattr(als, "ITEM_BLOCK", 20)
    counts = []
    mine = {}
    for r in tastes.for_all(10, counts).collect():
        mine.setdefault(r["user_id"], {})[r["video_id"]] = r["score"]
    theirs = {}
    rows = tastes.model.recommendForAllUsers(10).select("user_idx", F.explode("recommendations").alias("rec")).join(tastes.users, "user_idx")
    for r in rows.select("user_id", "rec.video_idx", "rec.rating").join(tastes.videos, "video_idx").collect():
        theirs.setdefault(r["user_id"], {})[r["video_id"]] = r["rating"]
    assert mine.keys() == theirs.keys()
    for user, scores in theirs.items():
        assert sorted(mine[user].values()) == pytest.approx(sorted(scores.values()), abs=1e-5)
        last = min(scores.values())
        assert {v for v, s in scores.items() if s > last + 1e-5} <= mine[user].keys()
    items = tastes.videos.count()
    assert sum(counts) < 0.6 * len(mine) * (items / 20)


def test_closest_factors_are_brute_force(tastes):
    counts = []
    found = similarity.item_factor_similarity(tastes, 5, limit=20, counts=counts).collect()
    vectors = {r["id"]: np.array(r["value"]) for r in tastes.item_vectors().collect()}
    names = sorted(vectors)
    products = (lambda m: m @ m.T)(np.array([vectors[n] for n in names]))
    got = {}
    for r in found:
        got.setdefault(r["video_id"], []).append(r["cosine"])
    for i, name in enumerate(names):
        assert sorted(got[name]) == pytest.approx(sorted(np.delete(products[i], i))[-5:], abs=1e-9)
    assert sum(counts) < 0.7 * len(names) * (len(names) / 20)


@pytest.mark.parametrize("bucket", [2000, 3])
def test_projections_find_nearly_all_neighbours(spark, monkeypatch, bucket):
    """Near groups on a sphere; with a small bound on buckets nearly all go through blocks, and none is lost."""
    from clipsense.operators import projections

    monkeypatch.setattr(projections, "BUCKET", bucket)
    monkeypatch.setattr(projections, "SAMPLE", 60)
    draw = np.random.default_rng(3)
    points = np.repeat(draw.normal(size=(40, 12)), 8, axis=0) + 0.15 * draw.normal(size=(320, 12))
    points /= np.sqrt((points**2).sum(axis=1, keepdims=True))
    vectors = staged(spark.createDataFrame([(f"i{k:04}", p.tolist()) for k, p in enumerate(points)], "id string, value array<double>"))
    told_by = {}
    found = {}
    for r in projections.nearest(vectors, 12, 4, limit=64, told=told_by).collect():
        found.setdefault(r["left"], []).append((r["right"], r["product"]))
    products, hits = points @ points.T, 0
    for k in range(320):
        exact = np.sort(np.delete(products[k], k))[-4:]
        mine = found.get(f"i{k:04}", [])
        assert all(p == pytest.approx(products[k, int(name[1:])]) for name, p in mine)
        hits += sum(p >= exact[0] - 1e-9 for _, p in mine)
    assert hits >= 0.9 * 4 * 320
    assert told_by["width"] is None or told_by["tables"] >= 1
