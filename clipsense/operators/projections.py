"""Near neighbours by random projections: buckets that near vectors share, then exact products.

A vector of length one is projected on random directions; the places of a few
projections on a grid, together, are a bucket, and vectors that share a bucket in any
of the tables are compared by their product. How wide the grid is and how many
tables there are is *measured*: for a sample of bounded size the exact
neighbours are found through the blocks of ``operators/blocks.py``, and the
cheapest setting is taken that brings at least the wanted share of them into a
common bucket. Where none does, or where vectors lie in a bucket of more than
``BUCKET`` rows, blocks give those vectors' neighbours exactly: no pair of a large
bucket is made, and none is lost.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsense.operators.blocks import arrange, top_products
from clipsense.operators.ranking import top_per_key
from clipsense.session import staged

SAMPLE = 256
TABLES = 24
#: Projections of a table, and grid widths to try, the finest first.
DIRECTIONS = 3
WIDTHS = (0.15, 0.3, 0.6, 1.2)
BUCKET = 2_000
#: A setting may make so many pairs for each vector; beyond, blocks are cheaper.
PAIRS_EACH = 4_000
SEED = 42


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def bucketed(vectors: DataFrame, features: int, width: float, tables: int = TABLES, directions: int = DIRECTIONS, seed: int = SEED) -> DataFrame:
    """id, value and ``buckets``, one number for each table."""
    draw = np.random.default_rng(seed)
    ways, offsets = draw.normal(size=(tables, directions, features)), draw.random((tables, directions))
    keys = [
        F.xxhash64(F.lit(t), *[
            F.floor(_dot("value", F.array(*[F.lit(float(x)) for x in way])) / width + float(offset)) for way, offset in zip(ways[t], offsets[t])
        ])
        for t in range(tables)
    ]
    return vectors.select("id", "value", F.array(*keys).alias("buckets"))


def _cost(rows: DataFrame, tables: int) -> list[int]:
    """Pairs that the first 1, 2, ... tables make, large buckets left out."""
    sizes = rows.select(F.posexplode("buckets").alias("table", "bucket")).groupBy("table", "bucket").count().filter(F.col("count") <= BUCKET)
    found = {r["table"]: r["pairs"] for r in sizes.groupBy("table").agg(F.sum(F.col("count") * F.col("count")).alias("pairs")).collect()}
    return list(np.cumsum([found.get(t, 0) for t in range(tables)]))


def _first_common(rows: DataFrame, pairs: DataFrame) -> list[int]:
    """Of each pair (left, right) the first table in which both share a bucket, ``TABLES`` if none."""
    left = rows.select(F.col("id").alias("left"), F.col("buckets").alias("left_buckets"))
    right = rows.select(F.col("id").alias("right"), F.col("buckets").alias("right_buckets"))
    same = F.array_position(F.zip_with("left_buckets", "right_buckets", lambda x, y: x == y), True)
    places = pairs.join(left, "left").join(right, "right").select(F.when(same > 0, same - 1).otherwise(TABLES).cast("int").alias("at"))
    return [r["at"] for r in places.collect()]


def nearest(vectors: DataFrame, features: int, k: int, recall: float = 0.95, limit: int = 2_048, told: dict | None = None) -> DataFrame:
    """left, right, product and rank: for every staged vector (id, value, of length one) its k nearest, or nearly.

    ``told`` takes the chosen width and number of tables, and how many vectors went through blocks.
    """
    blocks = arrange(vectors, limit, features=features)
    sample = staged(vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE))
    known = staged(top_products(sample, blocks, k))
    n, best = vectors.count(), None
    for width in WIDTHS:
        rows = bucketed(vectors, features, width)
        first = np.array(_first_common(rows, known.select("left", "right")))
        enough = [t for t in range(1, TABLES + 1) if len(first) and (first < t).mean() >= recall]
        if enough:
            cost = _cost(rows, TABLES)[enough[0] - 1]
            if cost <= PAIRS_EACH * n and (best is None or cost < best[0]):
                best = cost, width, enough[0]
    if told is not None:
        told.update(width=best and best[1], tables=best and best[2])
    if best is None:
        return top_products(vectors, blocks, k)
    rows = staged(bucketed(vectors, features, best[1], best[2]))
    places = rows.select("id", F.posexplode("buckets").alias("table", "bucket"))
    sizes = places.groupBy("table", "bucket").agg(F.count("*").alias("size"))
    sized = staged(places.join(sizes.filter(F.col("size") > 1), ["table", "bucket"]))
    crowded = staged(sized.filter(F.col("size") > BUCKET).select("id").distinct())
    if told is not None:
        told.update(through_blocks=crowded.count())
    small = sized.filter(F.col("size") <= BUCKET).select("table", "bucket", "id")
    pairs = (
        small.withColumnRenamed("id", "left").join(small.withColumnRenamed("id", "right"), ["table", "bucket"])
        .filter(F.col("left") < F.col("right")).select("left", "right").distinct()
    )
    left = vectors.select(F.col("id").alias("left"), F.col("value").alias("left_value"))
    right = vectors.select(F.col("id").alias("right"), F.col("value").alias("right_value"))
    products = pairs.join(left, "left").join(right, "right").select("left", "right", _dot("left_value", "right_value").alias("product")).filter("product > 0")
    ends = F.array(F.struct("left", "right"), F.struct(F.col("right").alias("left"), F.col("left").alias("right")))
    both = products.select(F.inline(ends), "product").join(crowded.withColumnRenamed("id", "left"), "left", "left_anti")
    order = [F.col("product").desc(), F.col("right")]
    found = top_per_key(both, "left", order, k)
    return found.unionByName(top_products(vectors.join(crowded, "id", "left_semi"), blocks, k))
