"""What a task of blocks holds is bounded, and sparse vectors cost their cells."""

import numpy as np
import pyarrow as pa
import pytest

from clipsense.operators import blocks, pairs

CELLS = "entity string, feature string, value double"


def sparse(seed, rows, features, each):
    draw = np.random.default_rng(seed)
    index = [sorted(draw.choice(features, draw.integers(0, each + 1), replace=False).tolist()) for _ in range(rows)]
    table = pa.table({"index": pa.array(index, pa.list_(pa.int64())), "value": pa.array([draw.integers(-3, 4, len(i)).astype(float).tolist() for i in index], pa.list_(pa.float64()))})
    dense = np.zeros((rows, features))
    for row, (places, values) in enumerate(zip(index, table.column("value").to_pylist())):
        dense[row, places] = values
    return blocks.Vectors(table), dense


@pytest.mark.parametrize("at_once", [1, 5, 4_000_000])
@pytest.mark.parametrize("features, each, factor", [(4_000, 8, 256), (30, 6, 0), (30, 6, 10**9), (5, 0, 256)])
def test_products_by_cells_and_by_matrix(monkeypatch, features, each, factor, at_once):
    monkeypatch.setattr(blocks, "SPARSE", factor)
    monkeypatch.setattr(blocks, "CELL_PRODUCTS", at_once)
    left, dense_left = sparse(1, 60, features, each)
    right, dense_right = sparse(2, 90, features, each)
    assert (blocks.multiply(left, right) == dense_left @ dense_right.T).all()


def test_sparse_vectors_make_no_matrix(monkeypatch):
    """Thirty cells of 100,000 features: a matrix of all common features would take 2e10 products."""
    left, _ = sparse(3, 500, 100_000, 30)
    right, _ = sparse(4, 500, 100_000, 30)
    monkeypatch.setattr(np, "intersect1d", None)
    monkeypatch.setattr(blocks, "FEATURES", 0)  # no piece of a matrix has no features
    products = blocks.multiply(left, right)
    assert products.shape == (500, 500) and np.count_nonzero(products) < 5_000


def test_tasks_that_keep_all_products_are_small(spark, monkeypatch):
    """However many askers a block has, one task gives back no more than some askers times the block."""
    monkeypatch.setattr(blocks, "PAIRS_CHUNK", 10)
    given = []
    met = blocks._met

    def spy(visits, *rest):
        given.append(visits.groupBy("block", "chunk").count().agg({"count": "max"}).first()[0])
        return met(visits, *rest)

    monkeypatch.setattr(blocks, "_met", spy)
    rows = [(f"e{i:03}", "all", float(1 + i % 3)) for i in range(200)]
    found = pairs.all_products(spark.createDataFrame(rows, CELLS), 5, block_entities=20)
    assert {(r["left"], r["right"], r["product"]) for r in found.collect()} == {(a, b, v * w) for a, _, v in rows for b, _, w in rows if a != b}
    assert given[0] <= 30


def test_pairs_of_heavy_features_are_not_shuffled(spark):
    """Only the blocks are grouped; light features still add to what the blocks give."""
    rows = [(f"e{i:02}", "all", 1.0) for i in range(40)]
    told = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    heavy = pairs.all_products(spark.createDataFrame(rows, CELLS), 5, block_entities=8)
    assert "sum(product" not in told(heavy) and heavy.count() == 40 * 39
    both = pairs.all_products(spark.createDataFrame([*rows, ("e00", "own", 2.0), ("e01", "own", 3.0)], CELLS), 5, block_entities=8)
    assert "sum(product" in told(both)
    assert {(r["left"], r["right"]): r["product"] for r in both.filter("product > 1").collect()} == {("e00", "e01"): 7.0, ("e01", "e00"): 7.0}


def test_tasks_that_keep_the_best_hold_no_more_askers_with_more_rows():
    assert blocks.CHUNK <= 4_096 and blocks.PAIRS_CHUNK <= blocks.CHUNK


def test_products_made_at_once_are_some_megabytes():
    """A worker's memory is that of one slice of askers and a block, some copies of their products, and the rows found."""
    assert blocks.SLICE * blocks.BLOCK_ROWS * 8 <= 4 * 2**20
    assert blocks.SLICE <= blocks.PAIRS_CHUNK <= blocks.CHUNK <= 2_048
