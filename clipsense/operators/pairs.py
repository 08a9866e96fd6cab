"""Sums of products between the sparse rows of one table with itself.

``cells`` holds (entity, feature, value), one row per cell. The product of two
entities is the sum over their common features of value times value. Joining
all cells with themselves on the feature makes the square of each feature's
holders, most of it for pairs that nobody asks for. So features are put in
order, the common ones first, and an entity's cells from that end are *left out
of the join* as long as all of them together cannot give what a pair needs:

* ``similar_pairs``: while their length is below the threshold. Two entities that
  reach it share a cell that both have in the join (their rarest common one).
* ``top_partners``: while the sum of value times the feature's largest value is
  below the entity's k-th product by its rarest features alone. A better
  partner shares a cell that the entity has in the join.

Pairs that meet are summed up, and those whose sum and whatever the cells left
out could add stay below what is needed are dropped; only the others look up
those cells, cell by cell, starting from the entity that has fewer.

Where the whole join has no more than ``PLAIN_PAIRS`` pairs and no heavy feature,
it is made as it is: leaving cells out then costs more than it saves. Beyond, without a
heavy feature and with a threshold below ``LIKELY_BELOW``, ``similar_pairs`` sends four bytes for each pair of a feature's holders (a
hash and an upper bound of the value), sums up the bounds, and makes the products of the
few pairs whose bounds reach the threshold (``likely_pairs``).

A feature that still has more than ``limit`` holders is *heavy*: it is never
joined. Entities with heavy cells are laid out in blocks of like ones, and
blocks meet only where their largest values say that it matters
(``operators/blocks.py``). No shuffle key is a heavy feature, and no array holds
more than an entity's heavy cells.

The order has one step for each power of two of holders, so that an entity's
running sums are some forty rows, whatever the entity holds.

Entities with the same cells have the same products with everybody. Where there
are many of them, ``top_partners`` looks for partners of the *first* (smallest id)
of each such group only, and among such firsts only; what all members of a group
have in common is one list (``Groups``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipsense.operators.blocks import arrange, products_from, top_products
from clipsense.operators.ranking import top_per_key
from clipsense.session import staged

HOLDER_LIMIT = 2_000
BLOCK_ENTITIES = 2_048
#: Features with so few holders give the first lists of ``top_partners``.
RARE_HOLDERS = 32
BROADCAST_ROWS = 100_000
PAIRS_AT_LEAST = 100_000  # per task, below the usual number of tasks
PAIRS_AT_MOST = 4_000_000  # per task, above it
#: Pairs that are joined as they are.
PLAIN_PAIRS = 100_000_000
#: Entities are grouped if a group has so many on average.
ALIKE = 2
#: Steps of heavy features come before all others.
HEAVY_STEP = 1_000
#: Bounds give way by so much, against rounding.
MARGIN = 1e-9
SINGLE_MARGIN = 1e-6
#: The low byte of a posting is a level, and no value is above exp(-level / LEVELS); the rest are hash bits.
LEVEL_MASK = 255
LEVELS = 24.0
#: Up to this threshold few cells can be left out of a join, and ``similar_pairs`` goes by bounds of the values.
LIKELY_BELOW = 0.5
#: Cells of an entity that are sent as one part.
LARGE = 10_000

_VECTOR = "array<struct<feature:string,value:double>>"


def split_by_holders(cells: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None, int]:
    """``split_and_count`` without the number of pairs."""
    return split_and_count(cells, limit)[:3]


def split_and_count(cells: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None, int, int]:
    """Cells of features within the limit, cells beyond it (or None), and the
    number of tasks and pairs of joining the former with themselves.

    That number follows the pairs to come, not the size of the cells: a small
    table can have very many pairs. Features beyond the limit are counted
    first; a short list is broadcast, a long one joined like any table.
    """
    holders = cells.groupBy("feature").agg(F.count("*").alias("n"))
    heavy = F.col("n") > limit
    sizes = holders.agg(
        F.count_if(heavy).alias("heavy"),
        F.coalesce(F.sum(F.when(~heavy, F.col("n") * F.col("n"))), F.lit(0)).alias("pairs"),
    ).first()
    usual = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(usual, sizes["pairs"] // PAIRS_AT_LEAST), sizes["pairs"] // PAIRS_AT_MOST)
    if sizes["heavy"] == 0:
        return cells, None, tasks, sizes["pairs"]
    names = staged(holders.filter(heavy).select("feature"))
    side = F.broadcast(names) if sizes["heavy"] <= BROADCAST_ROWS else names
    return cells.join(side, "feature", "left_anti"), cells.join(side, "feature", "left_semi"), tasks, sizes["pairs"]


def vectors(cells: DataFrame) -> DataFrame:
    """The heavy cells of each entity as one array, in feature order."""
    items = F.array_sort(F.collect_list(F.struct("feature", "value")))
    return cells.groupBy("entity").agg(items.cast(_VECTOR).alias("vector"))


def light_products(cells: DataFrame, tasks: int) -> DataFrame:
    """(left, right, product) over the common features, with left < right."""
    placed = cells.repartition(tasks, "feature")
    left = placed.select(F.col("entity").alias("left"), "feature", F.col("value").alias("left_value"))
    right = placed.select(F.col("entity").alias("right"), "feature", F.col("value").alias("right_value"))
    return (
        left.join(right, "feature")
        .filter(F.col("left") < F.col("right"))
        .groupBy("left", "right")
        .agg(F.sum(F.col("left_value") * F.col("right_value")).alias("product"))
    )


def both_ways(pairs: DataFrame) -> DataFrame:
    """Each pair and its mirror image."""
    ends = F.array(
        F.struct("left", "right"), F.struct(F.col("right").alias("left"), F.col("left").alias("right"))
    )
    return pairs.select(F.inline(ends), "product")


def graded(cells: DataFrame, limit: int) -> DataFrame:
    """Add ``step``, higher for features with more holders, ``heavy`` and ``most``, the feature's largest value. Staged.

    Heavy features are a short list and reach the cells by broadcast; the others
    have at most ``limit`` cells each, so none is a hot key.
    """
    features = staged(cells.groupBy("feature").agg(F.count("*").alias("n"), F.max(F.abs("value")).alias("most")))
    heavy = F.col("n") > limit
    told = features.select("feature", "most", heavy.alias("heavy"), (F.floor(F.log2("n")) + F.when(heavy, HEAVY_STEP).otherwise(0)).alias("step"))
    hot = told.filter("heavy")
    n_hot = hot.count()
    if not n_hot:
        return staged(cells.join(told, "feature"))
    hot = F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot
    light = cells.join(hot.select("feature"), "feature", "left_anti").join(told.filter("NOT heavy"), "feature")
    return staged(light.unionByName(cells.join(hot, "feature")))


def left_out(cells: DataFrame, share: Column, needed: Column) -> DataFrame:
    """entity, ``cut``, ``outside`` and ``fewer``: what an entity leaves out of the join.

    From the highest step down, the shares of an entity's cells are summed up;
    those above ``cut`` stay below ``needed`` together, ``outside`` is their sum, and
    ``fewer`` their number. ``cells`` has a row for each cell, with what ``needed`` reads.
    """
    steps = cells.groupBy("entity", "step").agg(F.sum(share).alias("share"), F.count("*").alias("n"), F.first(needed).alias("needed"))
    running = Window.partitionBy("entity").orderBy(F.col("step").desc())
    so_far = steps.withColumn("total", F.sum("share").over(running)).withColumn("total_n", F.sum("n").over(running))
    # What is needed gives way, so that rounding leaves too little out rather than too much.
    out = F.coalesce(F.col("total") < F.col("needed") * (1 - MARGIN) - MARGIN, F.lit(False))
    return so_far.groupBy("entity").agg(
        F.coalesce(F.max(F.when(~out, F.col("step"))), F.lit(-1)).alias("cut"),
        F.coalesce(F.max(F.when(out, F.col("total"))), F.lit(0.0)).alias("outside"),
        F.coalesce(F.max(F.when(out, F.col("total_n"))), F.lit(0)).alias("fewer"),
    )


def completed(pairs: DataFrame, cells: DataFrame, missing: Column) -> DataFrame:
    """Add to the products of pairs (left, right, product, fewer_left, fewer_right and what ``missing`` reads)
    those of the cells for which ``missing`` holds.

    The cells of the entity with fewer of them are taken, and looked up one by one with the other.
    """
    from_left = F.col("fewer_left") <= F.col("fewer_right")
    asked = pairs.withColumn("few", F.when(from_left, F.col("left")).otherwise(F.col("right"))).withColumn(
        "many", F.when(from_left, F.col("right")).otherwise(F.col("left"))
    )
    own = cells.select(F.col("entity").alias("few"), "feature", "value", "step", "loose")
    other = cells.select(F.col("entity").alias("many"), "feature", F.col("value").alias("other"))
    extra = (
        asked.join(own, "few").filter(missing).select("left", "right", "many", "feature", "value")
        .join(other, ["many", "feature"])
        .groupBy("left", "right").agg(F.sum(F.col("value") * F.col("other")).alias("extra"))
    )
    return pairs.join(extra, ["left", "right"], "left").select("left", "right", (F.col("product") + F.coalesce("extra", F.lit(0.0))).alias("product"))


def numbered_vectors(cells: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """id, index and value of every entity, features as numbers; ``extra`` adds columns by entity. Staged."""
    names = staged(cells.select("feature").distinct())
    one = names.coalesce(1) if names.count() <= BROADCAST_ROWS else names
    numbers = staged(one.withColumn("number", F.monotonically_increasing_id()))
    numbers = F.broadcast(numbers) if one is not names else numbers
    items = F.array_sort(F.collect_list(F.struct("number", "value")))
    rows = cells.join(numbers, "feature").groupBy(F.col("entity").alias("id")).agg(items.alias("items"))
    rows = rows.select("id", F.col("items.number").alias("index"), F.col("items.value").alias("value"))
    return staged(rows if extra is None else rows.join(extra.withColumnRenamed("entity", "id"), "id"))


def _unsettled(found: DataFrame, heavy: DataFrame, k: int) -> DataFrame:
    """Entities whose k best so far a partner by heavy features could still enter, with their ``kth`` product.

    No such partner has a larger product than the entity's heavy values times
    the largest value of each heavy feature.
    """
    cells = heavy.select("entity", "feature", "value")
    most = cells.groupBy("feature").agg(F.max("value").alias("most"))
    reach = cells.join(most, "feature").groupBy("entity").agg(F.sum(F.col("value") * F.col("most")).alias("reach"))
    kth = found.filter(F.col("rank") == k).select(F.col("left").alias("entity"), F.col("product").alias("kth"))
    open_ended = F.col("kth").isNull() | (F.col("kth") <= F.col("reach") + MARGIN)
    return reach.join(kth, "entity", "left").filter(open_ended).select("entity", "kth")


def _heavy_partners(heavy: DataFrame, unsettled: DataFrame, k: int, block_entities: int, counts: list[int] | None) -> DataFrame:
    """k best partners by heavy features alone, for the unsettled entities.

    Entities with equal vectors have equal products with everybody. Of each
    such group only the k + 1 smallest ids can be among anyone's k best (one
    may be the entity itself), and one member can ask for all of them; it asks
    for what the least of their k-th products lets in.
    """
    known = numbered_vectors(heavy).withColumn("kind", F.sha2(F.to_json(F.struct("index", "value")), 256))
    members = known.join(unsettled.withColumnRenamed("entity", "id"), "id").select(F.col("id").alias("left"), "kind", "kth")
    front = staged(top_per_key(known, "kind", ["id"], k + 1, "place"))
    floors = members.groupBy("kind").agg(F.when(F.count_if(F.col("kth").isNull()) == 0, F.min("kth")).alias("floor"))
    askers = staged(front.filter("place = 1").join(floors, "kind").select(F.col("kind").alias("id"), "index", "value", "floor"))
    offers = arrange(staged(front.select("id", "index", "value")), block_entities)
    best = top_products(askers, offers, k + 1, apart=False, counts=counts).select(F.col("left").alias("kind"), "right", "product")
    return members.join(best, "kind").filter(F.col("left") != F.col("right")).select("left", "right", "product")


@dataclass
class Groups:
    """Entities with the same cells, and the partners that each such group has.

    ``members``: entity and the ``first`` of its group. ``lists``: of each group (``left`` is
    its first) the k + 1 entities ``right`` with the largest products, members of its own
    included, with ``product`` and ``rank``. An entity's k partners are those of the list
    without itself, of these the first k.
    """

    members: DataFrame
    lists: DataFrame
    k: int

    def partners(self) -> DataFrame:
        """left, right, product and rank: the k partners of every entity."""
        lists = self.lists.groupBy("left").agg(F.array_sort(F.collect_list(F.struct("rank", "right", "product"))).alias("list"))
        others = F.slice(F.filter("list", lambda row: row["right"] != F.col("entity")), 1, self.k)
        rows = self.members.join(lists.withColumnRenamed("left", "first"), "first").select(
            F.col("entity").alias("left"), F.posexplode(others).alias("place", "row")
        )
        return rows.select("left", "row.right", "row.product", (F.col("place") + 1).alias("rank"))


def alike(cells: DataFrame) -> tuple[DataFrame, bool]:
    """entity and ``first``, the smallest entity with the same cells (staged), and whether groups have ``ALIKE`` members on average.

    Equal cells have equal sums of the four parts of their md5; no array of cells is made.
    """
    code = F.md5(F.to_json(F.struct("feature", "value")))
    parts = [F.sum(F.conv(F.substring(code, at, 8), 16, 10).cast("bigint")).alias(f"part{at}") for at in (1, 9, 17, 25)]
    key = ["n", "part1", "part9", "part17", "part25"]
    signs = staged(cells.groupBy("entity").agg(F.count("*").alias("n"), *parts))
    firsts = staged(signs.groupBy(*key).agg(F.min("entity").alias("first")))
    many = ALIKE * firsts.count() <= signs.count()
    return (staged(signs.join(firsts, key).select("entity", "first")) if many else signs), many


def grouped_partners(
    cells: DataFrame, k: int, limit: int = HOLDER_LIMIT, block_entities: int = BLOCK_ENTITIES, counts: list[int] | None = None
) -> Groups | None:
    """The k partners with the largest products, by groups of entities with the same cells; None where groups are small.

    Of another group's members, the first k come before all of the next group with the same
    product whose first is larger, so the k best groups by product and first are enough.
    """
    cells = cells.filter(F.col("entity").isNotNull() & F.col("feature").isNotNull())
    members, many = alike(cells)
    if not many:
        return None
    firsts = members.select("first").distinct().withColumnRenamed("first", "entity")
    own = staged(cells.join(firsts, "entity"))
    near = _partners(own, k, limit, block_entities, counts).select("left", "right", "product")
    itself = own.groupBy("entity").agg(F.sum(F.col("value") * F.col("value")).alias("product"))
    near = near.unionByName(itself.select(F.col("entity").alias("left"), F.col("entity").alias("right"), "product"))
    fronts = staged(top_per_key(members, "first", ["entity"], k + 1, "place").select(F.col("first").alias("right"), "entity"))
    sizes = fronts.groupBy("right").agg(F.count("*").alias("size"))
    # Once groups with larger products hold k + 1 members, a group is out of reach.
    up_to_here = Window.partitionBy("left").orderBy(F.col("product").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    peers = Window.partitionBy("left", "product")
    able = (
        near.join(sizes, "right")
        .withColumn("better", F.sum("size").over(up_to_here) - F.sum("size").over(peers))
        .filter(F.col("better") <= k)
        .select("left", "right", "product")
    )
    every = able.join(fronts, "right").select("left", F.col("entity").alias("right"), "product")
    return Groups(members, staged(top_per_key(every, "left", [F.col("product").desc(), F.col("right")], k + 1)), k)


def top_partners(
    cells: DataFrame, k: int, limit: int = HOLDER_LIMIT, block_entities: int = BLOCK_ENTITIES, counts: list[int] | None = None, grouped: bool = True
) -> DataFrame:
    """The k partners with the largest products, per entity. Values are positive.

    ``counts`` takes how often an entity, or a group of the same cells, met a block in each round.
    Without ``grouped`` no groups are looked for.
    """
    groups = grouped_partners(cells, k, limit, block_entities, counts) if grouped else None
    return _partners(cells, k, limit, block_entities, counts) if groups is None else groups.partners()


def _partners(cells: DataFrame, k: int, limit: int, block_entities: int, counts: list[int] | None) -> DataFrame:
    """``top_partners`` of entities that are seldom alike.

    A partner that shares a cell of the entity in the join is found there with
    its whole product. One that shares none has too small a product, or is
    among the k best by heavy features alone. Where both ways find a partner,
    the whole product is the larger one.
    """
    order = [F.col("product").desc(), F.col("right")]
    light, hot, tasks, n_pairs = split_and_count(cells, limit)
    if hot is None and n_pairs <= PLAIN_PAIRS:
        return top_per_key(both_ways(light_products(light, tasks)), "left", order, k)
    every = graded(cells, limit)
    rare, _, few_tasks = split_by_holders(cells, min(limit, RARE_HOLDERS))
    # What an entity has with its partners by rare features alone, it has at least.
    first_lists = top_per_key(both_ways(light_products(rare, few_tasks)), "left", order, k)
    floors = staged(first_lists.filter(F.col("rank") == k).select(F.col("left").alias("entity"), F.col("product").alias("floor")))
    outside = staged(left_out(every.join(floors, "entity", "left"), F.col("value") * F.col("most"), F.col("floor")))
    heavy = every.filter("heavy")
    hot = heavy.groupBy("entity").agg(F.sum(F.col("value") * F.col("most")).alias("hot"), F.count("*").alias("n_hot"))
    sizes = every.groupBy("entity").agg(F.count("*").alias("cells"))
    asking = outside.join(hot, "entity", "left").join(floors, "entity", "left").select(
        "entity", "floor", F.least("cut", F.lit(HEAVY_STEP - 1)).alias("cut"),
        # The highest steps are those of heavy features: all of them are outside, and no fewer than have been left out.
        F.greatest("outside", F.coalesce("hot", F.lit(0.0))).alias("outside"),
        F.greatest("fewer", F.coalesce("n_hot", F.lit(0))).alias("fewer"),
    )
    placed = light.repartition(tasks, "feature")
    mine = every.filter("NOT heavy").join(asking.select("entity", "cut"), "entity").filter(F.col("step") <= F.col("cut"))
    left = mine.select(F.col("entity").alias("left"), "feature", F.col("value").alias("left_value")).repartition(tasks, "feature")
    right = placed.select(F.col("entity").alias("right"), "feature", F.col("value").alias("right_value"))
    met = left.join(right, "feature").filter(F.col("left") != F.col("right")).groupBy("left", "right").agg(
        F.sum(F.col("left_value") * F.col("right_value")).alias("product")
    )
    if not asking.filter("fewer > 0").limit(1).count():  # nothing has been left out
        return top_per_key(met, "left", order, k)
    needs = F.coalesce("floor", F.lit(0.0)) * (1 - MARGIN) - MARGIN
    able = staged(
        met.join(asking.withColumnRenamed("entity", "left").withColumnRenamed("fewer", "fewer_left"), "left")
        .join(sizes.select(F.col("entity").alias("right"), F.col("cells").alias("fewer_right")), "right")
        .filter(F.col("product") + F.col("outside") >= needs)
    )
    # Of those, only what can still reach the k-th product by what has been summed up.
    kth = top_per_key(able.select("left", "right", "product"), "left", order, k).filter(F.col("rank") == k).select("left", F.col("product").alias("kth"))
    open_pairs = able.join(kth, "left", "left").filter(
        F.col("kth").isNull() | (F.col("product") + F.col("outside") >= F.col("kth") * (1 - MARGIN) - MARGIN)
    )
    whole = completed(open_pairs, every.withColumn("loose", F.lit(False)), F.col("step") > F.col("cut"))
    found = staged(top_per_key(whole, "left", order, k))
    if not heavy.limit(1).count():
        return found
    more = _heavy_partners(heavy, _unsettled(found, heavy, k), k, block_entities, counts)
    best = found.drop("rank").unionByName(more).groupBy("left", "right").agg(F.max("product").alias("product"))
    return top_per_key(best, "left", order, k)


def all_products(cells: DataFrame, limit: int = HOLDER_LIMIT, block_entities: int = BLOCK_ENTITIES) -> DataFrame:
    """The product of every two entities with a common feature, both ways.

    Here the pairs are the result; heavy features still go through the blocks,
    so no task holds more than a block and some askers, and blocks without a common
    feature do not meet. Values are positive. Where all features are heavy, the
    products of the blocks are whole, and pairs leave the tasks without a shuffle.
    """
    light, heavy, tasks, n_pairs = split_and_count(cells, limit)
    if heavy is None:
        return both_ways(light_products(light, tasks))
    more = products_from(arrange(numbered_vectors(heavy), block_entities), 0.0)
    if n_pairs:
        more = light_products(light, tasks).unionByName(more).groupBy("left", "right").agg(F.sum("product").alias("product"))
    return both_ways(more)


def likely_pairs(cells: DataFrame, sizes: DataFrame, threshold: float, tasks: int) -> DataFrame:
    """left and right, in either order, each pair once: all whose product can reach the positive threshold, and a few more. Staged.

    ``cells`` are staged and of unit-length entities, ``sizes`` their number by entity, staged too. A feature's holders are put
    in order of hash and id, and each is sent with those that follow: of these, hash bits and an upper bound
    of the value in one number. Where an entity's bounds are summed up by hash bits, entities that share
    them only add to a bound; those of the sums that are large enough are looked up by them. What is
    sent for an entity of many cells is split by hash bits.
    """
    bits = F.hash("entity").bitwiseAND(~LEVEL_MASK)
    level = F.least(F.floor(-F.log(F.least(F.abs("value"), F.lit(1.0))) * LEVELS), F.lit(LEVEL_MASK)).cast("int")
    posting = F.struct(bits.alias("bits"), "entity", F.abs("value").cast("float").alias("value"), bits.bitwiseOR(level).alias("packed"))
    usable = cells.filter(F.col("entity").isNotNull() & F.col("feature").isNotNull() & (F.col("value") != 0))
    lists = usable.groupBy("feature").agg(F.array_sort(F.collect_list(posting)).alias("list")).filter(F.size("list") > 1)
    sent = lists.select("list", F.explode(F.sequence(F.lit(1), F.size("list") - 1)).alias("place")).select(
        F.element_at("list", F.col("place"))["entity"].alias("left"), F.element_at("list", F.col("place"))["value"].alias("own"),
        F.slice("list", F.col("place") + 1, F.size("list"))["packed"].alias("others"),
    )
    key = ["left"]
    large = staged(sizes.filter(F.col("cells") > LARGE).select(F.col("entity").alias("left"), F.ceil(F.col("cells") / LARGE).cast("int").alias("parts")))
    n_large = large.count()
    if n_large:
        side = F.broadcast(large) if n_large <= BROADCAST_ROWS else large
        place = lambda x: F.pmod(F.shiftright(x, 8), F.col("parts"))
        split = sent.join(side, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        split = split.withColumn("others", F.filter("others", lambda x: place(x) == F.col("part")))
        sent = sent.join(side, "left", "left_anti").withColumn("part", F.lit(0)).unionByName(split.drop("parts"))
        key = ["left", "part"]
    # Sent once, by the left entity: neither the sums nor the filter need another shuffle.
    met = sent.repartition(tasks, *key).select(*key, "own", F.explode("others").alias("packed"))
    bound = F.col("own").cast("double") * F.exp(F.col("packed").bitwiseAND(LEVEL_MASK) / -LEVELS)
    sums = met.groupBy(*key, F.col("packed").bitwiseAND(~LEVEL_MASK).alias("bits")).agg(F.sum(bound).alias("bound"))
    able = staged(sums.filter(F.col("bound") >= threshold * (1 - SINGLE_MARGIN)).select("left", "bits"))
    names = sizes.select(F.col("entity").alias("right"), F.hash("entity").bitwiseAND(~LEVEL_MASK).alias("bits"))
    first = F.hash("left").bitwiseAND(~LEVEL_MASK)
    later = (first < F.col("bits")) | ((first == F.col("bits")) & (F.col("left") < F.col("right")))
    return staged(able.join(names, "bits").filter(later).select("left", "right"))


def similar_pairs(
    cells: DataFrame, threshold: float, limit: int = HOLDER_LIMIT, block_entities: int = BLOCK_ENTITIES, counts: list[int] | None = None
) -> DataFrame:
    """Every pair of unit-length entities with a product of at least ``threshold``, left < right.

    ``counts`` takes how often an entity met a block.
    """
    cells = staged(cells.select("entity", "feature", "value"))
    light, hot, tasks, n_pairs = split_and_count(cells, limit)
    if hot is None and n_pairs <= PLAIN_PAIRS:
        return light_products(light, tasks).filter(F.col("product") >= threshold)
    if hot is None and 0 < threshold <= LIKELY_BELOW:
        sizes = staged(cells.groupBy("entity").agg(F.count("*").alias("cells")))
        asked = likely_pairs(cells, sizes, threshold, tasks).withColumn("product", F.lit(0.0))
        for side in ("left", "right"):
            asked = asked.join(sizes.toDF(side, f"fewer_{side}"), side)
        found = completed(staged(asked), cells.withColumn("step", F.lit(0)).withColumn("loose", F.lit(False)), F.lit(True))
        return found.filter(F.col("product") >= threshold).select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right"), "product")
    # Heavy are the features that many have in the join; that is known when it is known what they leave out.
    steps = graded(cells, 2**62)
    square = F.col("value") * F.col("value")
    outside = staged(left_out(steps, square, F.lit(threshold * threshold)))
    joined = staged(steps.join(outside.select("entity", "cut"), "entity").filter(F.col("step") <= F.col("cut")).select("entity", "feature", "value"))
    light, heavy, tasks = split_by_holders(joined, limit)
    loose = F.lit(False)
    every = steps.withColumn("loose", loose)
    ends = outside.withColumn("slack", F.sqrt("outside"))
    if heavy is not None:
        hot = heavy.select("feature").distinct().withColumn("loose", F.lit(True))
        hot = staged(hot)
        side = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot
        every = staged(steps.join(side, "feature", "left").withColumn("loose", F.coalesce("loose", F.lit(False))))
        parts = heavy.groupBy("entity").agg(F.sum(square).alias("hot"), F.count("*").alias("n_hot"))
        ends = staged(
            outside.join(parts, "entity", "left").select(
                "entity", "cut", (F.col("fewer") + F.coalesce("n_hot", F.lit(0))).alias("fewer"),
                F.sqrt(F.col("outside") + F.coalesce("hot", F.lit(0.0))).alias("slack"),
            )
        )

    def told(pairs: DataFrame) -> DataFrame:
        for side in ("left", "right"):
            names = {"entity": side, "cut": f"cut_{side}", "slack": f"slack_{side}", "fewer": f"fewer_{side}"}
            pairs = pairs.join(ends.select(*[F.col(a).alias(b) for a, b in names.items()]), side)
        return pairs.withColumn("cut", F.least("cut_left", "cut_right"))

    # Common cells that are not in both joins lie outside of the join of the entity with the lower cut.
    rest = (
        F.when(F.col("cut_left") == F.col("cut_right"), F.col("slack_left") * F.col("slack_right"))
        .when(F.col("cut_left") < F.col("cut_right"), F.col("slack_left"))
        .otherwise(F.col("slack_right"))
    )
    able = staged(told(light_products(light, tasks)).filter(F.col("product") + rest >= threshold - MARGIN))
    found = completed(able, every, (F.col("step") > F.col("cut")) | F.col("loose"))
    if heavy is not None:
        slack = outside.select("entity", F.sqrt("outside").alias("slack"))
        blocks = arrange(numbered_vectors(heavy, slack), block_entities)
        more = products_from(blocks, threshold, counts).join(able.select("left", "right"), ["left", "right"], "left_anti")
        counted = F.col("loose") & (F.col("step") <= F.col("cut"))
        found = found.unionByName(completed(staged(told(more)), every, ~counted))
    return found.filter(F.col("product") >= threshold)


def unit_cells(cells: DataFrame) -> DataFrame:
    """Divide each entity's values by its length; zero rows are left out."""
    norms = cells.groupBy("entity").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
    return cells.join(norms.filter("norm > 0"), "entity").select(
        "entity", "feature", (F.col("value") / F.col("norm")).alias("value")
    )
