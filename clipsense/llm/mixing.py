"""Mixing sources to target weights, by blocks of words.

The words of a source, its documents in a fixed pseudorandom order, are packed
into blocks of equal length. Targets are shares of all words by weight; none
exceeds ``MOST_REPEATS`` times what its source has, and what is cut off there
goes to the others by weight. Each output shard has a fixed number of slots; how
many of them go to each source is drawn at random from the slots owed to the sources,
without putting back (a multinomial draw that all shards together keep to the
targets: multivariate hypergeometric). The draw goes down a tree: the slots of a
range of shards are split among its halves, with a seed of that range, so that a
task finds the counts of its shards by a walk from the root, and no one goes
through all of them. The slots of a source are numbered through all
shards, and slot j takes block p(j mod n) of its n blocks, where p is a
pseudorandom permutation of the source and of the pass j div n: no block is used
a second time before all were used once. Slots meet blocks by index.

Defined cases: a null text has no words, is taken by no slot and keeps its row
with 0; the null source is a source of its own, the last in order; repeated
rows are mixed like any others; an empty table gives no rows; further columns
are ignored. The driver holds one number a source. Everything random is a hash or a seeded draw, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipsense.llm.numbering import buckets_for, running
from clipsense.llm.texts import n_words, with_value, word_spans
from clipsense.session import staged

#: The weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
#: Words of a block, and slots of an output shard.
BLOCK = 128
SHARD_SLOTS = 65_536
SEED = 20_251
#: Shards whose counts a task walks down to at once.
RANGE = 64
#: Fixed value: the library's hypergeometric draws end below it.
MOST_DRAWN = 10**9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST_REPEATS) -> DataFrame:
    """source, source_size, weight and target; ``sizes`` has source and size.

    One row for each source. The level is raised in rounds: sources that reach
    their ceiling leave, the others share the rest by weight.
    """
    # The table of sources is as long as there are sources, each a setting of the mix.
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    share = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("n") - 1, F.lit(len(weights))) + 1)
    table = staged(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("n", F.row_number().over(order)).withColumn("weight", share)
        .withColumn("ceiling", F.col("source_size") * most)
    )
    level = 0.0
    while True:
        full = F.col("ceiling") <= F.col("weight") * F.lit(level)
        row = table.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, F.col("ceiling")).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not row["all"] or not row["open"]:
            break
        higher = (row["all"] - row["fixed"]) / row["open"]
        if higher <= level:
            break
        level = higher
    return table.withColumn("target", F.least("ceiling", F.col("weight") * F.lit(level))).drop("ceiling")


def permuted(index: np.ndarray, n: int, *salt: int) -> np.ndarray:
    """A pseudorandom permutation of 0 .. n - 1 for each salt, at the given places.

    Rounds of adding a hash of one coordinate to the other permute a square
    grid of at least n places; who lands beyond n goes on until below n.
    """
    side = np.uint64(math.isqrt(max(n - 1, 0)) + 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] // side, out[todo] % side
        for step in range(4):
            left, right = right, (left + _mixed(right, step, *salt) % side) % side
        out[todo] = left * side + right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _mixed(x: np.ndarray, *salt: int) -> np.ndarray:
    """64 well-mixed bits of each number and the salt."""
    for part in salt:
        x = (x ^ np.uint64(part % 2**64)) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return x


def _drawn(draw: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n draws without putting back are good.

    Beyond a thousand million, where the library draws no more, by the normal
    distribution of that mean and variance, within what is possible.
    """
    if good + bad < MOST_DRAWN:
        return int(draw.hypergeometric(good, bad, n))
    total = good + bad
    spread = math.sqrt(n * (good / total) * (bad / total) * ((total - n) / (total - 1)))
    return min(max(round(n * (good / total) + draw.normal() * spread), n - bad, 0), good, n)


def _split(owed: np.ndarray, n: int, *salt: int) -> np.ndarray:
    """What n slots, drawn at random from those owed to the sources, give to each of them."""
    draw, left = np.random.Generator(np.random.PCG64(list(salt))), int(owed.sum())
    if left < MOST_DRAWN:
        return draw.multivariate_hypergeometric(owed, n, method="marginals")
    out = np.zeros_like(owed)
    for s, good in enumerate(owed.tolist()):
        out[s] = _drawn(draw, good, left - good, n)
        left, n = left - good, n - int(out[s])
    return out


def range_counts(
    owed: list[int], first: int, last: int, shard_slots: int = SHARD_SLOTS, seed: int = SEED
) -> Iterator[tuple[int, int, int, int]]:
    """shard, source number, first slot of the source and slots, for the shards from first to last - 1."""
    total = sum(owed)
    work = [(0, -(-total // shard_slots), np.array(owed, dtype=np.int64), np.zeros(len(owed), dtype=np.int64))]
    while work:
        a, b, left, given = work.pop()
        if b <= first or a >= last or a >= b:
            continue
        if b - a == 1:
            yield from ((a, int(s), int(given[s]), int(left[s])) for s in np.flatnonzero(left))
            continue
        middle = (a + b) // 2
        before = _split(left, (middle - a) * shard_slots, seed, a, b)
        work += [(middle, b, left - before, given + before), (a, middle, before, given)]


def slot_counts(owed: list[int], shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> list[tuple[int, int, int, int]]:
    """``range_counts`` of all shards."""
    return list(range_counts(owed, 0, -(-sum(owed) // shard_slots), shard_slots, seed))


def mix(
    documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK, shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The documents with their targets, and what each slot takes of which document.

    The first has doc_id, text_hash, source, size, source_size, target, from_word
    (place in the source's words); the second has n (the source's number), shard, slot,
    pass, doc_id, text_hash, from_word, first, taken: words first .. first + taken - 1.
    """
    spark = documents.sparkSession
    sizes = staged(documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "source", n_words(F.col("text")).alias("size")))
    rows = sizes.count()
    targets = staged(
        source_targets(sizes, weights)
        .withColumn("blocks", F.ceil(F.col("source_size") / block))
        # Blocks of a source average source_size / blocks words, the last one being short.
        .withColumn("slots", F.round(F.col("target") * F.col("blocks") / F.greatest("source_size", F.lit(1))).cast("long"))
    )
    placed = staged(
        running(sizes, ["source"], ["doc_id", "text_hash"], F.col("size"), "from_word", buckets_for(rows))
        .join(targets.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    )
    owed = [row["slots"] for row in targets.orderBy("n").select("slots").collect()]
    shards = -(-sum(owed) // shard_slots)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "s", "first_slot", "slots_here"]
        for batch in batches:
            for at in batch.column(0).to_pylist():
                rows = list(range_counts(owed, at, at + RANGE, shard_slots, seed))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    counts = spark.range(0, shards, RANGE).mapInArrow(count, "shard long, s long, first_slot long, slots_here long")
    # A row stands for at most ``shard_slots`` slots.
    drawn = counts.join(targets.select((F.col("n") - 1).cast("long").alias("s"), "n", "blocks"), "s").repartition("s", "shard")

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                slot = np.arange(row["first_slot"], row["first_slot"] + row["slots_here"])
                turn = slot // row["blocks"]
                index = np.empty_like(slot)
                for t in np.unique(turn):
                    index[turn == t] = permuted(slot[turn == t] % row["blocks"], row["blocks"], seed, row["n"], int(t))
                yield pa.RecordBatch.from_pydict({
                    "shard": np.full(len(slot), row["shard"]), "n": np.full(len(slot), row["n"], dtype=np.int32),
                    "slot": slot, "pass": turn, "index": index,
                })

    slots = drawn.select("shard", "n", "blocks", "first_slot", "slots_here").mapInArrow(
        spread, "shard long, n int, slot long, pass long, index long"
    )
    pieces = placed.filter("size > 0 and slots > 0").withColumn(
        "index", F.explode(F.expr(f"sequence(from_word div {block}, (from_word + size - 1) div {block})"))
    ).select("n", "index", "doc_id", "text_hash", "from_word", "size")
    begin = F.greatest(F.col("index") * block, F.col("from_word"))
    end = F.least((F.col("index") + 1) * block, F.col("from_word") + F.col("size"))
    # Spark cannot see how many slots a count stands for; neither side may be broadcast.
    takings = slots.select("n", "index", "shard", "slot", "pass").join(pieces.hint("merge"), ["n", "index"]).select(
        "n", "shard", "slot", "pass", "doc_id", "text_hash", "from_word",
        (begin - F.col("from_word")).alias("first"), (end - begin).alias("taken"),
    )
    return placed, takings


def mix_counts(documents: DataFrame, **settings) -> DataFrame:
    """Every document with its size, its source's size and target, and the words taken of it."""
    placed, takings = mix(documents, **settings)
    key = ["doc_id", "text_hash", "n", "from_word"]
    taken = takings.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.sum("taken").alias("taken"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    return placed.join(taken, same[0] & same[1] & same[2] & same[3] & (F.col("size") > 0), "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mix_texts(documents: DataFrame, **settings) -> DataFrame:
    """The documents the mix takes something of, with all columns; the text is what it takes.

    Runs of words are kept as they stand, pass after pass, joined by line
    breaks. Equal texts with one id come as one row that has what is taken of all.
    """
    _, takings = mix(documents, **settings)
    runs = takings.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("from_word", "pass", "first", "taken"))).alias("runs")
    ).select(F.col("doc_id").alias("taken_id"), F.col("text_hash").alias("taken_hash"), "runs")
    rows = documents.select(
        F.struct(*[c for c in documents.columns if c != "text"]).alias("rest"), "text",
        F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_hash"),
    ).dropDuplicates(["own_id", "own_hash"])
    joined = rows.join(runs, F.col("own_id").eqNullSafe(F.col("taken_id")) & (F.col("own_hash") == F.col("taken_hash")))
    mixed = with_value(joined.select("rest", "text", "runs"), ["text", "runs"], lambda: taken_text, "mixed", "string")
    return mixed.select(*[F.col("mixed").alias(c) if c == "text" else F.col("rest")[c].alias(c) for c in documents.columns])


def taken_text(text: str, runs: list[dict]) -> str:
    """The runs of words of a text, those that follow each other in one pass as one."""
    starts, ends = word_spans(text)
    merged: list[list[int]] = []
    before = None
    for run in runs:
        turn = (run["from_word"], run["pass"])
        if before == turn and merged[-1][1] == run["first"]:
            merged[-1][1] += run["taken"]
        else:
            merged.append([run["first"], run["first"] + run["taken"]])
        before = turn
    return "\n".join(text[starts[a] : ends[b - 1]] for a, b in merged)
