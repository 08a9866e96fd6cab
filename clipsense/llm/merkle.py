"""A Merkle manifest of a table by butterfly exchange.

Every row is a leaf; the leaves of one group, in order, form a tree of fanout
eight, and the groups' roots form one more. The tree is cut into aligned blocks
of 8 ** 4 leaves, which are hashed in one task each. The levels above are made
in rounds: the eight subtrees of a node swap their roots, block with block of
the same place, so that *every* block learns its siblings at that level and
hashes the ancestor itself. After the last round each block has the group's root
and the whole upper part of its leaves' proofs, and nothing is sent down again.
A block meets seven others a round, whatever the size of the group; where the
last subtree of a node is not full, its blocks stand in for the missing ones.

Leaves get their places from a range partitioning of (group, order): one count a
partition and group, summed up, is what a row needs besides its place inside its
partition. Range keys end in a row number, so equal rows are split as well.

Defined cases: a null value counts as ``-``; a null group comes before the
others; a null id comes first in its group, ties go by digest, and equal rows
are leaves each; a table of one row has that leaf as its root, with the digest
of nothing as its proof; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipsense.session import staged

FANOUT = 8
#: Levels of the tree below a block's root.
BLOCK_LEVELS = 4
#: Small tables of counts and group proofs are broadcast up to so many rows (a proof has some kilobytes).
BROADCAST_ROWS = 10_000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<before:string,after:string>>"
#: The low bits of monotonically_increasing_id, the place within a partition.
_PLACE_BITS = 33


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value with its length in bytes, so that no two rows of values are written alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def tree_of(group: Column) -> Column:
    """The group as a string without nulls, in the groups' order, null first."""
    return F.coalesce(F.concat(F.lit("v"), group.cast("string")), F.lit("n"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``pos``, the gapless place in the tree, and ``n``, its leaves. ``nodes`` must be staged."""
    partitions = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["tree", *order, "_tie"]
    sorted_rows = (
        nodes.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(partitions, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_row", _PLACE_BITS))
        .drop("_tie")
    )
    rows = staged(sorted_rows)
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("tree", "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_here"))
    starts = staged(
        counts.select(
            "tree", "_part", "_first",
            F.coalesce(F.sum("_here").over(before), F.lit(0)).alias("_start"),
            F.sum("_here").over(Window.partitionBy("tree")).alias("n"),
        )
    )
    return (
        rows.join(_small(starts), ["tree", "_part"])
        .withColumn("pos", F.col("_start") + F.col("_row") - F.col("_first"))
        .drop("_part", "_row", "_first", "_start")
    )


def levels(digests: list[str], whole: bool, block_levels: int = BLOCK_LEVELS) -> list[list[str]]:
    """The nodes of a block, level by level; a block that is a whole tree ends at its root."""
    found = [digests]
    while len(found[-1]) > 1 if whole else len(found) <= block_levels:
        last = found[-1]
        found.append([digest("".join(last[i : i + FANOUT])) for i in range(0, len(last), FANOUT)])
    return found


def siblings(found: list[list[str]], at: int) -> list[tuple[str, str]]:
    """For each level, what stands before and after the node above leaf ``at`` in its run."""
    path = []
    for nodes in found[:-1]:
        run = at - at % FANOUT
        path.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + FANOUT])))
        at //= FANOUT
    return path


def fold(leaf: str, path: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for before, after in path:
        leaf = digest(before + leaf + after)
    return leaf


def block_roots(placed: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """tree, block, blocks and root of every block."""
    size = FANOUT**block_levels

    def root(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        n = table.column("n")[0].as_py()
        top = levels(table.column("leaf").to_pylist(), n <= size, block_levels)[-1][0]
        return pa.table(
            {"tree": table.column("tree").slice(0, 1), "block": table.column("block").slice(0, 1), "blocks": [-(-n // size)], "root": [top]},
            schema=pa.schema([("tree", pa.string()), ("block", pa.int64()), ("blocks", pa.int64()), ("root", pa.string())]),
        )

    return (
        placed.select("tree", "block", "pos", "n", "leaf")
        .groupBy("tree", "block")
        .applyInArrow(root, "tree string, block bigint, blocks bigint, root string")
    )


def _joined(members: Column, condition) -> Column:
    return F.array_join(F.transform(F.filter(members, condition), lambda m: m["root"]), "")


def _round(state: DataFrame, span: int) -> DataFrame:
    """Subtrees of ``span`` blocks swap their roots with up to seven others; all hash their common ancestor."""
    subtree = F.floor(F.col("block") / span)
    seat = F.col("block") % span
    here = F.least(F.lit(span), F.col("blocks") - subtree * span)  # blocks of the subtree; they also sit for those that a subtree which is not full lacks
    last_seat = F.when(subtree % FANOUT == 0, seat).otherwise(F.lit(span - 1))
    sent = state.select(
        "*", subtree.alias("subtree"), seat.alias("own_seat"), F.explode(F.sequence(seat, last_seat, here)).alias("seat")
    )
    own = F.when(F.col("seat") == F.col("own_seat"), F.struct("block", "blocks", "path"))
    met = sent.groupBy("tree", F.floor(F.col("subtree") / FANOUT).alias("family"), "seat").agg(
        F.sort_array(F.collect_list(F.struct((F.col("subtree") % FANOUT).alias("digit"), "root", own.alias("own")))).alias("members")
    )
    each = met.select("tree", "members", F.explode(F.filter("members", lambda m: m["own"].isNotNull())).alias("me"))
    told = each.select(
        "tree", "me.own.block", "me.own.blocks", "me.own.path", F.col("me.root").alias("root"),
        _joined(F.col("members"), lambda m: m["digit"] < F.col("me.digit")).alias("before"),
        _joined(F.col("members"), lambda m: m["digit"] > F.col("me.digit")).alias("after"),
    )
    above = F.col("blocks") > span
    return told.select(
        "tree", "block", "blocks",
        F.when(above, F.sha2(F.concat("before", "root", "after").cast("binary"), 256)).otherwise(F.col("root")).alias("root"),
        F.when(above, F.concat("path", F.array(F.struct("before", "after")))).otherwise(F.col("path")).alias("path"),
    )


def exchange(roots: DataFrame) -> DataFrame:
    """tree, block, the tree's root and the block's path to it, for every block; ``roots`` must be staged."""
    most = roots.agg(F.max("blocks")).first()[0] or 0
    state = roots.withColumn("path", F.array().cast(_PATH))
    span = 1
    while span < most:
        state = staged(_round(state, span))
        span *= FANOUT
    return state.select("tree", "block", "root", "path")


def _tree(nodes: DataFrame, order: Sequence[str], block_levels: int) -> tuple[DataFrame, DataFrame]:
    """Leaves with their places, and what every block knows after the exchange."""
    placed = numbered(nodes, order).withColumn("block", F.floor(F.col("pos") / FANOUT**block_levels))
    return placed, exchange(staged(block_roots(placed, block_levels)))


def _paths(placed: DataFrame, upper: DataFrame, block_levels: int) -> DataFrame:
    """id, root and whole path of every leaf of a small tree."""
    size = FANOUT**block_levels

    def spread(leaves: pa.Table, above: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("pos")
        found = levels(leaves.column("leaf").to_pylist(), leaves.column("n")[0].as_py() <= size, block_levels)
        top = above.column("path")[0].as_py()
        paths = [[{"before": b, "after": a} for b, a in siblings(found, at)] + top for at in range(leaves.num_rows)]
        kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        return pa.table(
            {"id": leaves.column("id"), "root": above.column("root").to_pylist() * leaves.num_rows, "path": pa.array(paths, kind)},
        )

    key = ["tree", "block"]
    return placed.groupBy(*key).cogroup(upper.groupBy(*key)).applyInArrow(spread, f"id string, root string, path {_PATH}")


def manifest(
    rows: DataFrame,
    columns: Sequence[str] = COLUMNS,
    group: str = "lang",
    order: str = "doc_id",
    present: Mapping[str, Column] | None = None,
    proofs: bool = False,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for every row.

    The digests are those of ``columns``. ``present`` names columns whose values
    are now others; a row is verified if its present values and the siblings in
    the manifest lead to the manifest's root. ``proofs`` adds the siblings
    themselves, ``path``: for each level what stands before and after.
    """
    size = FANOUT**block_levels
    now = [(present or {}).get(c, F.col(c)) for c in columns]
    leaf = row_digest([F.col(c) for c in columns])
    differs = F.lit(False)
    for column, value in (present or {}).items():
        differs = differs | ~F.col(column).eqNullSafe(value)
    nodes = staged(
        rows.select(
            F.col(order).alias("id"), tree_of(F.col(group)).alias("tree"), leaf.alias("leaf"),
            F.when(differs, row_digest(now)).alias("shown"),
        )
    )
    placed, upper = _tree(nodes, ["id", "leaf"], block_levels)
    placed = placed.select("tree", "block", "pos", "n", "id", "leaf", "shown")
    subroots = staged(upper.filter("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("id"), F.col("root").alias("leaf")))
    trees = staged(_paths(*_tree(subroots, ["id"], block_levels), block_levels))
    above = upper.withColumnRenamed("root", "subroot").join(
        _small(trees.select(F.col("id").alias("tree"), "root", F.col("path").alias("top"))), "tree"
    ).select("tree", "block", "subroot", "root", F.concat("path", "top").alias("path"))

    id_type = nodes.schema["id"].dataType.simpleString()
    schema = f"doc_id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    schema += f", path {_PATH}" if proofs else ""

    def prove(leaves: pa.Table, above: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("pos")
        own, shown = leaves.column("leaf").to_pylist(), leaves.column("shown").to_pylist()
        found = levels(own, leaves.column("n")[0].as_py() <= size, block_levels)
        subroot, root, top = (above.column(c)[0].as_py() for c in ("subroot", "root", "path"))
        top = [(p["before"], p["after"]) for p in top]
        shared = "".join(b + a for b, a in top).encode()
        hashes, folded, paths = [], [], []
        for at, (leaf, other) in enumerate(zip(own, shown)):
            path = siblings(found, at)
            proof = hashlib.sha256("".join(b + a for b, a in path).encode())
            proof.update(shared)
            hashes.append(proof.hexdigest())
            folded.append(fold(other or leaf, path + top))
            if proofs:
                paths.append([{"before": b, "after": a} for b, a in path + top])
        n = leaves.num_rows
        out = {
            "doc_id": leaves.column("id"), "leaf": leaves.column("leaf"), "subroot": [subroot] * n, "root": [root] * n,
            "proof_sha256": hashes, "folded_root": folded, "verified": [f == root for f in folded],
        }
        if proofs:
            out["path"] = pa.array(paths, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))
        return pa.table(out)

    key = ["tree", "block"]
    return placed.groupBy(*key).cogroup(above.groupBy(*key)).applyInArrow(prove, schema)
