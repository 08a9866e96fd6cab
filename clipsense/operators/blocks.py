"""Inner products of vectors, block by block, leaving out blocks that cannot matter.

A vector is (id, index, value): the features it has, and their values; without
the column ``index`` a vector has all features, in order. The *offers* are laid out in blocks of like vectors: by length first, then by their
largest features. A summary tells of each block the largest absolute value of
every feature and the greatest length. An *asker* meets a block only if the
bound from the summary - the sum of its values times the block's largest, or
length times length - says that a product there can reach what it needs.

``top_products`` visits the blocks of each asker in falling order of their
bounds, one in the first round and eight times as many in each that follows,
and stops an asker once the next bound is below its k-th best product so far.
``products_from`` visits every block that can hold a product from a threshold on.
Both are exact: nothing is left out but what cannot be in the result.

The summary goes to every task. Its size does not grow with the data: at most
``SUMMARY_CELLS`` numbers, blocks get larger instead, and features beyond
``SUMMARY_FEATURES`` share cells, which loosens bounds but keeps them bounds. A
task holds one block and some ``CHUNK`` askers of it, and takes ``SLICE`` of them at
a time. Where all products from a threshold on are kept, blocks meet in *tiles*, the pairs of
some blocks with some others: a block is sent once to each tile that needs it, however many
blocks it meets there, and a task gives back slice by slice what it finds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsense.operators.ranking import top_per_key
from clipsense.session import staged

BLOCK_ROWS = 2_048
SUMMARY_CELLS = 4_000_000
SUMMARY_FEATURES = 1_024
#: Askers that meet a block in one task, and those of them that are multiplied at once.
CHUNK = 2_048
PAIRS_CHUNK = 1_024
SLICE = 256
#: Cells and rows on each side of a tile, and tiles in a row of them at least.
TILE_CELLS = 2_000_000
TILE_ROWS = 65_536
LEAST_TILES = 16
#: Products that a tile gives back at once.
GIVEN_ROWS = 262_144
#: Features multiplied at once.
FEATURES = 4_096
#: Vectors are multiplied cell by cell if a matrix has so many times the products, and so many at once.
SPARSE = 256
CELL_PRODUCTS = 4_000_000
#: Largest features that decide about a vector's place.
LEADING = 3
#: Bounds are made a little larger, against rounding.
MARGIN = 1e-9
SINGLE_MARGIN = 1e-6

#: From bounds, askers and summary to the askers and blocks that are to meet.
Choose = Callable[[np.ndarray, pa.RecordBatch, "Summary"], tuple[np.ndarray, np.ndarray]]
#: From products, askers and a block to the rows and columns to keep.
Pick = Callable[[np.ndarray, pa.Table, pa.Table], tuple[np.ndarray, np.ndarray]]


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists in a row, and the row of each."""
    column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().fill_null(0))
    return np.asarray(column.flatten()), np.repeat(np.arange(len(lengths)), lengths)


class Vectors:
    """The vectors of a table: a matrix if they have all features, else in coordinates."""

    def __init__(self, table: pa.Table | pa.RecordBatch):
        table = table if isinstance(table, pa.Table) else pa.Table.from_batches([table])
        self.rows = table.num_rows
        values, self.row = _lists(table.column("value"))
        self.value = values.astype(np.float64)
        self.dense = "index" not in table.schema.names
        if self.dense:
            self.matrix = self.value.reshape(self.rows, -1 if self.rows else 0)
        else:
            self.feature = _lists(table.column("index"))[0]

    def folded(self, features: int) -> np.ndarray:
        """Rows by folded features: sums of absolute values."""
        if self.dense:
            return np.abs(self.matrix)
        out = np.bincount(self.row * features + self.feature % features, np.abs(self.value), self.rows * features)
        return out.reshape(self.rows, features)

    def most(self, features: int) -> np.ndarray:
        """The largest absolute value by folded feature."""
        if self.dense:
            return np.abs(self.matrix).max(axis=0)
        out = np.zeros(features)
        np.maximum.at(out, self.feature % features, np.abs(self.value))
        return out

    def lengths(self) -> np.ndarray:
        return np.sqrt(np.bincount(self.row, self.value**2, self.rows))

    @cached_property
    def by_feature(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature, row and value of all cells, in order of features."""
        order = np.argsort(self.feature, kind="stable")
        return self.feature[order], self.row[order], self.value[order]


def multiply(left: Vectors, right: Vectors) -> np.ndarray:
    """All products, feature by feature that both sides have; where those are few, cell by cell."""
    if left.dense:
        return left.matrix @ right.matrix.T
    features = right.by_feature[0]
    first, last = (np.searchsorted(features, left.feature, side) for side in ("left", "right"))
    common = np.unique(left.feature[last > first])
    if int((last - first).sum()) * SPARSE <= left.rows * right.rows * len(common):
        return _by_cells(left, right, first, last - first)
    out = np.zeros((left.rows, right.rows))
    for at in range(0, len(common), FEATURES):
        part = common[at : at + FEATURES]
        sides = []
        for side in (left, right):
            place = np.minimum(np.searchsorted(part, side.feature), len(part) - 1)
            has = part[place] == side.feature
            dense = np.zeros((side.rows, len(part)))
            dense[side.row[has], place[has]] = side.value[has]
            sides.append(dense)
        out += sides[0] @ sides[1].T
    return out


def _by_cells(left: Vectors, right: Vectors, first: np.ndarray, number: np.ndarray) -> np.ndarray:
    """All products, from the cells of the left and the ``number`` of cells from ``first`` on that each meets on the right."""
    _, rows, values = right.by_feature
    out = np.zeros(left.rows * right.rows)
    pieces = np.searchsorted(np.cumsum(number), np.arange(CELL_PRODUCTS, int(number.sum()), CELL_PRODUCTS))
    for cells in np.split(np.arange(len(number)), np.unique(pieces)):
        n = number[cells]
        own = np.repeat(cells, n)
        met = np.arange(len(own)) + np.repeat(first[cells] - np.cumsum(n) + n, n)
        np.add.at(out, left.row[own] * right.rows + rows[met], left.value[own] * values[met])
    return out.reshape(left.rows, right.rows)


def few_products(left: Vectors, right: Vectors) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]] | None:
    """Row on the left, row on the right and product of all rows with a common feature, in pieces; None where those are many.

    Only cells that meet are touched, so a piece costs its cells, however many rows there are.
    """
    if left.dense:
        return None
    left_features, left_rows, left_values = left.by_feature
    features, right_rows, right_values = right.by_feature
    first, last = (np.searchsorted(features, left_features, side) for side in ("left", "right"))
    number = last - first
    if int(number.sum()) * SPARSE > left.rows * right.rows:
        return None

    def pieces() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        by_row = np.bincount(left_rows, number, left.rows).astype(np.int64)
        # A row's cells are in one piece, whose cells meet some CELL_PRODUCTS others.
        piece = ((np.cumsum(by_row) - by_row) // CELL_PRODUCTS)[left_rows]
        meeting = np.flatnonzero(number)
        meeting = meeting[np.argsort(piece[meeting], kind="stable")]
        for cells in np.split(meeting, np.flatnonzero(np.diff(piece[meeting])) + 1):
            n = number[cells]
            own = np.repeat(cells, n)
            met = np.arange(len(own)) + np.repeat(first[cells] - np.cumsum(n) + n, n)
            place, where = np.unique(left_rows[own] * right.rows + right_rows[met], return_inverse=True)
            yield place // right.rows, place % right.rows, np.bincount(where, left_values[own] * right_values[met], len(place))

    return pieces()


def first_k(products: np.ndarray, able: np.ndarray, k: int) -> np.ndarray:
    """Which of the able products are among the k largest of their row; the first columns break ties."""
    many = np.flatnonzero(able.sum(axis=1) > k)
    if len(many):
        some = np.where(able[many], products[many], -np.inf)
        kth = np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k, None]
        larger, equal = some > kth, some == kth
        room = k - larger.sum(axis=1, keepdims=True)
        able[many] = larger | (equal & (np.cumsum(equal, axis=1) <= room))
    return able


@dataclass
class Summary:
    """Of each block: its number, largest values by folded feature, greatest length and slack."""

    blocks: np.ndarray
    most: np.ndarray
    lengths: np.ndarray
    slack: np.ndarray

    def bounds(self, askers: Vectors) -> np.ndarray:
        """Askers by blocks: no product is larger."""
        sums = askers.folded(self.most.shape[1]) @ self.most.T
        return np.minimum(sums, np.outer(askers.lengths(), self.lengths)) * (1 + MARGIN)

    def of(self, blocks: np.ndarray) -> Summary:
        """Of some blocks only."""
        order = np.argsort(self.blocks)
        places = order[np.searchsorted(self.blocks[order], blocks)]
        return Summary(self.blocks[places], self.most[places], self.lengths[places], self.slack[places])


@dataclass
class Blocks:
    """Offers in blocks (block, id, maybe index, value, slack) with their summary."""

    rows: DataFrame
    summary: Summary

    @property
    def id_type(self) -> str:
        return self.rows.schema["id"].dataType.simpleString()


def arrange(vectors: DataFrame, block_rows: int = BLOCK_ROWS, features: int = SUMMARY_FEATURES) -> Blocks:
    """Lay out staged vectors (id, maybe index, value, maybe slack) in blocks of like ones; dense ones have ``features``."""
    if "slack" not in vectors.columns:
        vectors = vectors.withColumn("slack", F.lit(0.0))
    n = vectors.count()
    blocks = max(1, min(-(-n // block_rows), SUMMARY_CELLS // features))
    length = F.sqrt(F.aggregate("value", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    index = F.col("index") if "index" in vectors.columns else F.sequence(F.lit(0), F.size("value") - 1)
    by_value = F.array_sort(F.zip_with(index, "value", lambda i, x: F.struct((-F.abs(x)).alias("less"), i.cast("bigint").alias("feature"))))
    leading = F.transform(F.slice(by_value, 1, LEADING), lambda c: c["feature"])
    dealt = (
        vectors.withColumn("_band", -F.floor(2 * F.log2(F.greatest(length, F.lit(1e-30)))))
        .withColumn("_leading", leading)
        .repartitionByRange(blocks, "_band", "_leading", "id")
        .select(F.spark_partition_id().cast("bigint").alias("block"), *[c for c in ("id", "index", "value", "slack") if c in vectors.columns])
    )
    rows = staged(dealt)

    def summed(table: pa.Table) -> pa.Table:
        vectors = Vectors(table)
        return pa.table({
            "block": table.column("block").slice(0, 1), "most": pa.array([vectors.most(features)]),
            "length": [float(vectors.lengths().max())], "slack": [max(table.column("slack").to_pylist())],
        })

    told = rows.groupBy("block").applyInArrow(summed, "block bigint, most array<double>, length double, slack double").toArrow()
    most = _lists(told.column("most"))[0].reshape(told.num_rows, features)
    block, length, slack = (told.column(c).to_numpy() for c in ("block", "length", "slack"))
    return Blocks(rows, Summary(block, most, length, slack))


def _visits(askers: DataFrame, offers: Blocks, choose: Choose, chunk: int) -> DataFrame:
    """block, chunk and the asker, for every block that ``choose`` names of an asker, staged."""
    shared = askers.sparkSession.sparkContext.broadcast(offers.summary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                asker, block = choose(summary.bounds(Vectors(part)), part, summary)
                for some in range(0, len(asker), SLICE):
                    rows = part.take(pa.array(asker[some : some + SLICE]))
                    blocks = pa.array(summary.blocks[block[some : some + SLICE]], pa.int64())
                    yield pa.RecordBatch.from_arrays([blocks, *rows.columns], names=["block", *part.schema.names])

    schema = "block bigint, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in askers.schema)
    chunks = -(-askers.count() // chunk) or 1
    return staged(askers.mapInArrow(run, schema).withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks))))


def _best_met(visits: DataFrame, offers: Blocks, pick: Pick, single: bool = False) -> DataFrame:
    """left, right and product of what ``pick`` keeps where askers meet a block. ``visits`` must be staged."""
    left_type = visits.schema["id"].dataType.simpleString()
    schema = f"left {left_type}, right {offers.id_type}, product double"
    needed = visits.select("block", "chunk").distinct().toDF("block", "chunk")
    blocks = offers.rows.join(needed, "block")

    def meet(askers: pa.Table, block: pa.Table) -> pa.Table:
        askers, block = askers.sort_by("id"), block.sort_by("id")
        right, found = Vectors(block), []
        for at in range(0, askers.num_rows, SLICE):
            part = askers.slice(at, SLICE)
            products = multiply(Vectors(part), right)
            products = products.astype(np.float32).astype(np.float64) if single else products
            i, j = pick(products, part, block)
            ids = part.column("id").take(pa.array(i)), block.column("id").take(pa.array(j))
            found.append(pa.table([*ids, pa.array(products[i, j])], names=["left", "right", "product"]))
        return pa.concat_tables(found)

    key = ["block", "chunk"]
    return visits.groupBy(*key).cogroup(blocks.groupBy(*key)).applyInArrow(meet, schema)


def _floors(part: pa.RecordBatch | pa.Table, margin: float = MARGIN) -> np.ndarray:
    """What a product has to reach, a little less; nothing where it is null."""
    floors = np.array(part.column("floor").to_pylist(), dtype=np.float64)
    return np.where(np.isnan(floors), -np.inf, floors - margin * (1 + np.abs(floors)))


def top_products(
    askers: DataFrame, offers: Blocks, k: int, positive: bool = True, apart: bool = True, single: bool = False,
    counts: list[int] | None = None,
) -> DataFrame:
    """left, right, product and rank: the k largest products of every asker (id, maybe index, value, maybe floor).

    Products below an asker's ``floor`` are not asked for; ``positive`` leaves out
    those that are not, ``apart`` those of an id with itself. Ids break ties.
    ``counts`` takes how often an asker met a block in each round.
    """
    if "floor" not in askers.columns:
        askers = askers.withColumn("floor", F.lit(None).cast("double"))
    askers = askers.select(*[c for c in ("id", "index", "value", "floor") if c in askers.columns])

    margin = SINGLE_MARGIN if single else MARGIN

    def between(first: int, last: int) -> Choose:
        def choose(bounds, part, summary):
            order = np.argsort(-bounds, axis=1, kind="stable")[:, first:last]
            reach = np.take_along_axis(bounds, order, 1)
            able = reach >= _floors(part, margin)[:, None]
            if positive:
                able &= reach > 0
            i, j = np.nonzero(able)
            return i, order[i, j]

        return choose

    def pick(products, part, block):
        able = products >= _floors(part, margin)[:, None]
        if positive:
            able &= products > 0
        if apart:
            own = pc.index_in(part.column("id"), block.column("id").combine_chunks()).fill_null(-1).to_numpy()
            able[np.flatnonzero(own >= 0), own[own >= 0]] = False
        return np.nonzero(first_k(products, able, k))  # the block is in order of ids

    order = [F.col("product").desc(), F.col("right")]
    best, asking, first, step, blocks = None, askers, 0, 1, len(offers.summary.blocks)
    while best is None or first < blocks:
        step = blocks if blocks - first <= 2 * step else step
        visits = _visits(asking, offers, between(first, first + step), CHUNK)
        met = visits.count()
        if counts is not None:
            counts.append(met)
        found = _best_met(visits, offers, pick, single)
        best = staged(top_per_key(found if best is None else best.drop("rank").unionByName(found), "left", order, k))
        if not met:
            break
        kth = best.filter(F.col("rank") == k).select(F.col("left").alias("id"), F.col("product").alias("kth"))
        asking = askers.join(kth, "id", "left").withColumn("floor", F.greatest("floor", "kth")).drop("kth")
        first, step = first + step, 8 * step
    return best


def _block_visits(offers: Blocks, choose: Choose) -> DataFrame:
    """chunk, block and n: the n askers of block ``chunk`` for which ``choose`` names a block, staged."""
    askers = offers.rows.withColumnRenamed("block", "own")
    shared = askers.sparkSession.sparkContext.broadcast(offers.summary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = shared.value
        for batch in batches:
            own, found = batch.column("own").to_numpy(), []
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                asker, block = choose(summary.bounds(Vectors(part)), part, summary)
                found.append(np.column_stack([own[at + asker], summary.blocks[block]]))
            pairs, n = np.unique(np.concatenate(found), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(n)], names=["chunk", "block", "n"])

    met = askers.filter(F.size("value") > 0).mapInArrow(run, "chunk bigint, block bigint, n bigint")
    return staged(met.groupBy("chunk", "block").agg(F.sum("n").alias("n")))


def _tiles(offers: Blocks) -> DataFrame:
    """block and the tile it is in on either side: blocks in order, of some ``TILE_CELLS`` cells or ``TILE_ROWS`` rows in all."""
    sizes = offers.rows.groupBy("block").agg(F.count("*").alias("rows"), F.sum(F.size("value")).alias("cells")).orderBy("block").toArrow()
    block, rows, cells = (np.asarray(sizes.column(c)) for c in ("block", "rows", "cells"))
    share = np.maximum(np.maximum(rows / TILE_ROWS, cells / TILE_CELLS), LEAST_TILES * rows / max(1, rows.sum()))
    tile = np.floor(np.cumsum(share) - share).astype(np.int64)
    # A row a block, as the summary.
    return offers.rows.sparkSession.createDataFrame(pa.table({"block": pa.array(block, pa.int64()), "tile": pa.array(tile, pa.int64())}))


def _met(visits: DataFrame, offers: Blocks, choose: Choose, threshold: float) -> DataFrame:
    """left, right and product from the threshold on where blocks (chunk, block) meet, each pair once. ``visits`` must be staged."""
    tiles = staged(_tiles(offers))
    key = ["chunk_tile", "block_tile"]
    wanted = visits.select("chunk", "block")
    for side in ("chunk", "block"):
        wanted = wanted.join(F.broadcast(tiles.toDF(side, f"{side}_tile")), side)
    wanted = staged(wanted)
    sides = [
        offers.rows.join(wanted.select(F.col(side).alias("block"), *key).distinct(), "block").withColumn("right", F.lit(side == "block"))
        for side in ("chunk", "block")
    ]
    sent = sides[0].unionByName(sides[1]).repartition(2 * wanted.select(*key).distinct().count() or 1, *key)
    shared = offers.rows.sparkSession.sparkContext.broadcast(offers.summary)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by([("block", "ascending"), ("id", "ascending")])
        # Both sides have whole blocks, and these in order of ids.
        left, right = (table.filter(pc.equal(table.column("right"), side)).combine_chunks() for side in (False, True))
        del table
        (owns, own_starts), (blocks, starts) = (np.unique(side.column("block").to_numpy(), return_index=True) for side in (left, right))
        own, block = (side.column("block").to_numpy() for side in (left, right))
        place, other = np.arange(left.num_rows) - own_starts[np.searchsorted(owns, own)], np.arange(right.num_rows) - starts[np.searchsorted(blocks, block)]
        slack, slacks = (side.column("slack").to_numpy() for side in (left, right))

        def given(i: np.ndarray, j: np.ndarray, products: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(i), GIVEN_ROWS):
                ids = [side.column("id").take(pa.array(rows[at : at + GIVEN_ROWS])) for side, rows in ((left, i), (right, j))]
                yield from pa.table([*ids, pa.array(products[at : at + GIVEN_ROWS])], names=["left", "right", "product"]).combine_chunks().to_batches()

        few = few_products(Vectors(left), Vectors(right))
        if few is not None:
            for i, j, products in few:
                able = (products >= threshold - np.maximum(slack[i], slacks[j]) - MARGIN) & (products > 0)
                able &= (own[i] < block[j]) | ((own[i] == block[j]) & (place[i] < other[j]))
                yield from given(i[able], j[able], products[able])
            return
        told = shared.value.of(blocks)
        ends = [*starts[1:], right.num_rows]
        vectors = [Vectors(right.slice(a, b - a)) for a, b in zip(starts, ends)]
        for start, end in zip(own_starts, [*own_starts[1:], left.num_rows]):
            for at in range(start, end, SLICE):
                asking = left.slice(at, min(SLICE, end - at))
                askers = Vectors(asking)
                _, met = choose(told.bounds(askers), asking.rename_columns({"block": "own"}), told)
                for b in np.unique(met):
                    products, here = multiply(askers, vectors[b]), slice(starts[b], ends[b])
                    able = products > 0
                    if threshold > 0:
                        able &= products >= threshold - np.maximum.outer(slack[at : at + len(products)], slacks[here]) - MARGIN
                    if own[at] == blocks[b]:
                        able &= place[at : at + len(products), None] < other[here]
                    i, j = np.nonzero(able)
                    yield from given(at + i, starts[b] + j, products[i, j])

    return sent.groupBy(*key).applyInArrow(meet, f"left {offers.id_type}, right {offers.id_type}, product double")


def products_from(offers: Blocks, threshold: float, counts: list[int] | None = None) -> DataFrame:
    """left, right and product of every two ids whose product is positive and reaches the threshold.

    A pair's threshold is less by the larger slack of the two. Each pair once, left < right.
    """
    def choose(bounds, part, summary):
        slack = np.maximum.outer(part.column("slack").to_numpy(), summary.slack)
        own = part.column("own").to_numpy()
        return np.nonzero((bounds >= threshold - slack - MARGIN) & (bounds > 0) & (summary.blocks >= own[:, None]))

    visits = _block_visits(offers, choose)
    if counts is not None:
        counts.append(visits.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    return _met(visits, offers, choose, threshold).select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right"), "product")
