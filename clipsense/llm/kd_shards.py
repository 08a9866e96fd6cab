"""K-d tree shards of near-equal bytes, by DataFrame operations only.

Every document is a point: its size, its id, and its language and source by a
hash, each scaled to 0 .. 2^31 - 1. A node that is to give k shards is cut at the
weighted median (by bytes, at (k div 2) / k) of the dimension in which it is
widest, until leaves hold the target, total bytes / shards. Behind each
coordinate stand 32 bits of a hash of the document, so that ties are split too.

The median of all nodes of a level is found at once, from histograms: bytes are
summed in up to 65,536 bins between a node's least and greatest code, the bin
where the running sum passes the target is opened again, until it is a single
code. What reaches the driver is one row for each node, at most ``shards``.

Defined cases: a null text has size 1 and the checksum of an empty text; null
coordinates count as 0; rows equal in all columns cannot be told apart and go
together; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipsense.llm.numbering import buckets_for, running
from clipsense.session import staged

SHARDS = 16
BIN_BITS = 16
SCALE = 2**31 - 1
DIMENSIONS = ("size", "doc_id", "lang", "source")


def coded(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, size, text_crc32 and one 63-bit code for each dimension."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        "doc_id", F.xxhash64("text", "lang", "source").alias("text_hash"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        *[F.shiftright(F.crc32(F.coalesce(F.col(name), F.lit(""))), 1).alias(f"_{name}") for name in ("lang", "source")],
    )
    rows = staged(rows)
    bounds = rows.agg(F.min("size"), F.max("size"), F.min("doc_id"), F.max("doc_id")).first()

    def scaled(name: str, low: int | None, high: int | None) -> Column:
        spread = max(1, (high or 0) - (low or 0))
        part = (F.coalesce(F.col(name), F.lit(low or 0)).cast("double") - float(low or 0)) / float(spread)
        return F.least(F.floor(part * SCALE), F.lit(SCALE)).cast("long")

    at = [scaled("size", bounds[0], bounds[1]), scaled("doc_id", bounds[2], bounds[3]), F.col("_lang"), F.col("_source")]
    tie = [F.crc32(F.concat_ws("|", F.col("doc_id").cast("string"), F.col("text_hash").cast("string"), F.lit(name))) for name in DIMENSIONS]
    return rows.select(
        "doc_id", "text_hash", "size", "text_crc32",
        F.array(*[F.shiftleft(a, 32) + t for a, t in zip(at, tie)]).alias("codes"),
    )


def _table(spark: SparkSession, columns: str, rows: Sequence[tuple]) -> DataFrame:
    """A table of at most ``shards`` rows of whole numbers, to be broadcast."""
    values = ", ".join("(" + ", ".join(f"{v}L" for v in row) + ")" for row in rows)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})"))


def split_level(points: DataFrame, leaves: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """Cut every node that is to give several shards; ``node`` is the first shard of a node."""
    spark = points.sparkSession
    code = F.element_at("codes", F.col("dim").cast("int"))
    dims = range(len(DIMENSIONS))
    spread = points.filter(F.col("node").isin([n for n, k in leaves.items() if k > 1])).groupBy("node").agg(
        F.sum("size").alias("bytes"),
        *[F.min(F.col("codes")[d]).alias(f"low{d}") for d in dims], *[F.max(F.col("codes")[d]).alias(f"high{d}") for d in dims],
    ).collect()
    # node -> dimension, least code, bits of the range, bytes wanted to the left of the cut, bytes left of the range
    state: dict[int, list] = {}
    for row in spread:
        d = max(dims, key=lambda i: (row[f"high{i}"] - row[f"low{i}"]) >> 32)
        k = leaves[row["node"]]
        state[row["node"]] = [d + 1, row[f"low{d}"], (row[f"high{d}"] - row[f"low{d}"]).bit_length(), row["bytes"] * (k // 2) // k, 0]
    cuts: dict[int, int] = {}
    while state:
        rows = [(n, d, low, bits, max(0, bits - BIN_BITS), want, left) for n, (d, low, bits, want, left) in state.items()]
        open_nodes = _table(spark, "node, dim, low, bits, shift, want, left_of", rows)
        bins = (
            points.join(open_nodes, "node").withColumn("rest", code - F.col("low"))
            .filter((F.col("rest") >= 0) & (F.expr("shiftright(rest, cast(bits AS int))") == 0))
            .groupBy("node", "want", "left_of", F.expr("shiftright(rest, cast(shift AS int))").alias("bin")).agg(F.sum("size").alias("bytes"))
        )
        by_bin = Window.partitionBy("node").orderBy("bin")
        passed = (
            bins.withColumn("until", F.col("left_of") + F.sum("bytes").over(by_bin))
            .filter(F.col("until") >= F.col("want"))
            .withColumn("first", F.row_number().over(by_bin)).filter("first = 1")
            .select("node", "bin", (F.col("until") - F.col("bytes")).alias("before"), "until").collect()
        )
        for row in passed:
            d, low, bits, want, _ = state[row["node"]]
            shift = max(0, bits - BIN_BITS)
            low += row["bin"] << shift
            if shift:
                state[row["node"]] = [d, low, shift, want, row["before"]]
                continue
            # A single code: it goes to the side that comes nearer to the target.
            cuts[row["node"]] = low + (row["until"] - want <= want - row["before"])
        state = {n: s for n, s in state.items() if n not in cuts}
    if not cuts:
        return points, {n: 1 for n in leaves}
    table = _table(spark, "cut_node, dim, cut, step", [
        (row["node"], 1 + max(dims, key=lambda i: (row[f"high{i}"] - row[f"low{i}"]) >> 32), cuts[row["node"]], leaves[row["node"]] // 2)
        for row in spread
    ])
    moved = points.join(table, F.col("node") == F.col("cut_node"), "left").withColumn(
        "node", F.col("node") + F.when(code >= F.col("cut"), F.col("step")).otherwise(F.lit(0))
    ).select(*points.columns)
    after: dict[int, int] = {}
    for node, k in leaves.items():
        after |= {node: 1} if k == 1 else {node: k // 2, node + k // 2: k - k // 2}
    return staged(moved), after


def shard(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every document with its shard, and its place there."""
    points = staged(coded(documents).withColumn("node", F.lit(0).cast("long")))
    rows = points.count()
    leaves = {0: shards}
    while any(k > 1 for k in leaves.values()):
        points, leaves = split_level(points, leaves)
    own = points.select("doc_id", "text_hash", "size", "text_crc32", F.col("node").cast("int").alias("shard"))
    return running(own, ["shard"], ["doc_id", "text_hash"], F.lit(1), "slot", buckets_for(rows)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
