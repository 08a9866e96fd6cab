"""Where all products from a threshold on are kept, blocks are sent once to each tile, not with every asker."""

import numpy as np
import pyarrow as pa
import pytest

from clipsense.operators import blocks
from clipsense.session import staged

SCHEMA = "id string, index array<bigint>, value array<double>"


def rows_of(dense):
    return [([int(f) for f in np.flatnonzero(row)], [float(row[f]) for f in np.flatnonzero(row)]) for row in dense]


def expected(dense, threshold):
    products = np.triu(dense @ dense.T, 1)
    return {(f"i{i:04}", f"i{j:04}"): products[i, j] for i, j in zip(*np.nonzero((products > 0) & (products >= threshold)))}


@pytest.mark.parametrize("least, cells", [(1, 10**6), (4, 10**6), (1, 30)])
@pytest.mark.parametrize("threshold", [0.0, 3.0])
def test_tiles_do_not_matter(spark, monkeypatch, least, cells, threshold):
    monkeypatch.setattr(blocks, "LEAST_TILES", least)
    monkeypatch.setattr(blocks, "TILE_CELLS", cells)
    monkeypatch.setattr(blocks, "GIVEN_ROWS", 7)
    draw = np.random.default_rng(11)
    dense = draw.integers(-2, 4, (80, 30)) * (draw.random((80, 30)) < 0.2).astype(float)
    vectors = staged(spark.createDataFrame([(f"i{k:04}", *row) for k, row in enumerate(rows_of(dense))], SCHEMA))
    found = blocks.products_from(blocks.arrange(vectors, 9), threshold).collect()
    assert len(found) == len({(r["left"], r["right"]) for r in found})
    assert {(r["left"], r["right"]): r["product"] for r in found} == expected(dense, threshold)


def test_sparse_vectors_meet_by_cells_and_visits_are_pairs_of_blocks(spark, monkeypatch):
    """A visit was a row with a vector for every asker and block."""
    monkeypatch.setattr(blocks, "LEAST_TILES", 1)
    dense = np.zeros((1_500, 751))
    dense[np.arange(1_500), np.arange(1_500) // 2] = 2.0
    dense[:3, 750] = 1.0
    visits, met = [], blocks._met
    monkeypatch.setattr(blocks, "_met", lambda told, *rest: visits.append(told.count()) or met(told, *rest))
    vectors = staged(spark.createDataFrame([(f"i{k:04}", *row) for k, row in enumerate(rows_of(dense))], SCHEMA))
    laid = blocks.arrange(vectors, 100)
    found = {(r["left"], r["right"]): r["product"] for r in blocks.products_from(laid, 0.5).collect()}
    assert found == expected(dense, 0.5)
    n = len(laid.summary.blocks)
    assert visits[0] <= n * (n + 1) // 2


@pytest.mark.parametrize("at_once", [1, 50, 4_000_000])
def test_few_products_are_those_of_the_matrix(monkeypatch, at_once):
    monkeypatch.setattr(blocks, "CELL_PRODUCTS", at_once)
    draw = np.random.default_rng(12)
    sides = [draw.integers(1, 5, (200, 3_000)) * (draw.random((200, 3_000)) < 0.002).astype(float) for _ in range(2)]
    tables = [pa.table({"index": pa.array([r[0] for r in rows_of(d)], pa.list_(pa.int64())), "value": pa.array([r[1] for r in rows_of(d)], pa.list_(pa.float64()))}) for d in sides]
    monkeypatch.setattr(blocks, "SPARSE", 1)
    out = np.zeros((200, 200))
    for i, j, products in blocks.few_products(*map(blocks.Vectors, tables)):
        assert (out[i, j] == 0).all()
        out[i, j] = products
    assert (out == sides[0] @ sides[1].T).all()
    monkeypatch.setattr(blocks, "SPARSE", 10**9)
    assert blocks.few_products(*map(blocks.Vectors, tables)) is None
