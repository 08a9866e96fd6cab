"""SpotSigs: fingerprints from chains of content words behind common words.

A spot is a common word (the anchor) and the content words that follow it at a
distance, each ``DISTANCE``-th content word until the chain has ``CHAIN`` words; a
document's signatures are the 32-bit hashes of its spots, as a set. A document
without a complete spot has one signature of its whole text, so equal texts
always have equal sets. The fingerprint writes the set out, eight hexadecimal
digits a signature in ascending order; the likeness of two is their Jaccard
coefficient.

Near duplicates are found among different sets. Sets are put into classes by
length, so wide that a pair at the threshold lies in one class or in two
neighbouring ones, and under the rarest of their signatures, as many as such a
pair cannot do without sharing ``IN_COMMON``. A signature that no second set has
there goes no further. Pairs under signatures of few sets are listed, if their
classes are neighbours, and those with enough keys compared. A signature of many
sets is a key for each class; under it, a pair is compared unless its lengths
already rule it out, or links found before join it; such a key is dealt to pairs of
blocks, so that no task holds more than two.

Defined cases: a null text counts as empty; the empty text has the signature of
the empty text; words are lower-cased and compared without the punctuation
around them; repeated rows follow each other in the order of documents; rows
with a null id come last in descending order; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby, islice
from math import ceil, log
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsense.llm.components import components
from clipsense.llm.texts import SLICE, slices, with_value
from clipsense.session import forget, staged

#: Common words of English, German, French and Spanish.
COMMON_WORDS = frozenset(
    "a an and are as at be by for from in is it of on or that the this to was with "
    "als auf aus das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "au avec dans de des du elle en est et il la le les ne pas pour que qui sur un une "
    "al con del el en es la las lo los no para por que se su un una y".split()
)
CHAIN = 2
DISTANCE = 1
THRESHOLD = 0.8
#: Sets of a block: a task compares two blocks at most.
BLOCK_SETS = 256
#: Keys that near sets must share, the most sets of a key whose pairs are listed, and the counters of signatures.
IN_COMMON = 3
FEW_SETS = 32
SLOTS = 2**18
#: Rows of a bucket of neighbouring ids, and the most buckets.
BUCKET_ROWS = 4_000
MOST_BUCKETS = 1_000
#: Stands for a null id in the order.
LEAST = -(2**63)
AROUND = ".,;:!?\"'()[]{}«»“”„…"


def signatures(text: str, chain: int = CHAIN, distance: int = DISTANCE) -> np.ndarray:
    """The sorted set of a text's 32-bit signatures."""
    anchors: list[tuple[str, int]] = []
    content: list[str] = []
    for word in text.lower().split():
        word = word.strip(AROUND)
        if word in COMMON_WORDS:
            anchors.append((word, len(content)))
        elif word:
            content.append(word)
    reach, crc = chain * distance, zlib.crc32
    last = len(content) - reach
    if chain == 2 and distance == 1:
        found = [crc(f"{anchor} {content[at]} {content[at + 1]}".encode()) for anchor, at in anchors if at <= last]
    else:
        found = [crc(" ".join([anchor, *content[at + distance - 1 : at + reach : distance]]).encode()) for anchor, at in anchors if at <= last]
    if not found:
        found = [zlib.crc32(text.encode())]
    return np.unique(np.array(found, dtype="u4"))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard coefficient of two sorted sets."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def written(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many first code points of the following one, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, next_doc_id bigint"
)
GROUPED = SCHEMA + ", class_id bigint"


def with_next(documents: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Documents dealt to buckets of neighbouring ids: bucket, extra, order_id, text_hash, doc_id, text, class_row, class_id.

    Within a bucket the ids descend, null ids last. The extra row at the end of
    a bucket is the first row of the bucket after it, after the last bucket
    that of the first. ``classes`` has a class_id for each order_id and text_hash; it
    comes as a row of its own, without a text, so that texts are dealt once.
    """
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text", *_place())
    n = min(MOST_BUCKETS, docs.count() // BUCKET_ROWS)
    bounds = docs.agg(F.percentile_approx("order_id", [i / (n + 1) for i in range(1, n + 1)], 10_000)).first()[0] if n else []
    bounds = np.array(bounds or [], dtype=np.int64)

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, ids.to_numpy()), dtype="int32")

    dealt = docs.withColumn("bucket", bucket_of("order_id"))
    # One row for each of at most MOST_BUCKETS + 1 buckets.
    firsts = sorted(tuple(r) for r in dealt.groupBy("bucket").agg(F.max(F.struct("order_id", "text_hash")).alias("first")).collect())
    ring = [(bucket, *firsts[(i + 1) % len(firsts)][1]) for i, (bucket, _) in enumerate(firsts)]
    heads = F.broadcast(spark.createDataFrame(ring, "to_bucket int, order_id bigint, text_hash bigint"))
    columns = ["bucket", "extra", "order_id", "text_hash", "doc_id", "text"]
    extras = docs.join(heads, ["order_id", "text_hash"]).dropDuplicates(["to_bucket"]).withColumnRenamed("to_bucket", "bucket")
    rows = dealt.withColumn("extra", F.lit(False)).select(*columns).union(extras.withColumn("extra", F.lit(True)).select(*columns))
    rows = rows.select(*columns, F.lit(False).alias("class_row"), F.lit(None).cast("bigint").alias("class_id"))
    if classes is None:
        return rows
    return rows.union(classes.select(
        bucket_of("order_id").alias("bucket"), F.lit(False), "order_id", "text_hash", F.lit(None).cast("bigint"),
        F.lit(None).cast("string"), F.lit(True), "class_id",
    ))


def _place() -> tuple[Column, Column]:
    """order_id and text_hash of a document."""
    return F.coalesce("doc_id", F.lit(LEAST)).alias("order_id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("text_hash")


def fingerprint_edits(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they and the next text's are.

    The next document is the one with the next smaller id, after the last one the first.
    """
    return _with_edits(documents, None)


def fingerprint_groups(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``fingerprint_edits`` and the class_id of ``near_groups`` for every document."""
    places, classes = _classes(documents.select(*_place(), "doc_id", "text"), ["order_id", "text_hash"], threshold)
    groups = staged(places.join(classes, "set_id").select("order_id", "text_hash", "class_id").distinct())
    forget(places, classes)
    return _with_edits(documents, groups)


def _with_edits(documents: DataFrame, classes: DataFrame | None) -> DataFrame:
    grouped = classes is not None
    schema = GROUPED if grouped else SCHEMA
    names = [part.split()[0] for part in schema.split(", ")]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        class_id = None
        for part in slices(batches):
            for bucket, extra, doc_id, text, class_row, new in zip(*(part.column(i).to_pylist() for i in (0, 1, 4, 5, 6, 7))):
                if class_row:
                    class_id = new
                else:
                    yield bucket, extra, doc_id, text, class_id

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        before = None
        for bucket, extra, doc_id, text, class_id in rows(batches):
            text = text or ""
            own = signatures(text)
            if before is not None and before[0] == bucket:
                _, old_id, old_text, old, old_class = before
                changed = edited(old_text, text)
                new = signatures(changed)
                yield (
                    old_id, len(old_text), hashlib.sha256(changed.encode()).hexdigest(), written(old), written(new),
                    likeness(old, new), likeness(old, own), doc_id,
                    *((old_class,) if grouped else ()),
                )
            before = None if extra else (bucket, doc_id, text, own, class_id)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = compared(batches)
        while chunk := list(islice(found, SLICE)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*chunk), KINDS)], names=names)

    sorted_rows = with_next(documents, classes).repartition("bucket").sortWithinPartitions(
        "bucket", "extra", F.desc("order_id"), F.desc("text_hash"), F.desc("class_row")
    )
    return sorted_rows.mapInArrow(run, schema)


def _class(n: Column, threshold: float) -> Column:
    # A touch wider than the threshold asks, for rounding.
    return F.floor(F.log(n) / (-log(threshold) * (1 + 1e-9))).cast("int")


def set_links(sets: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK_SETS) -> DataFrame:
    """Links a, b between sets, enough to connect all whose likeness reaches the threshold.

    ``sets`` has set_id and signatures, a row for each different set.
    """
    # One number for each of at most SLOTS slots.
    slots = sets.select(F.explode("signatures").alias("signature")).groupBy(F.pmod("signature", F.lit(SLOTS)).alias("slot")).count().toPandas()
    counts = np.zeros(SLOTS, dtype=np.int64)
    counts[slots["slot"].to_numpy(dtype=np.int64)] = slots["count"]
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    @F.pandas_udf("array<bigint>")
    def rarest(signatures: pd.Series) -> pd.Series:
        # Any order that all sets share finds the same pairs; with the rarer first, few sets meet.
        return signatures.map(lambda s: s[np.lexsort((s, shared.value[s % SLOTS]))][: _prefix(len(s), threshold)])

    n = F.size("signatures")
    keys = sets.select("set_id", n.alias("n"), _class(n, threshold).alias("own_kind"), F.explode(rarest("signatures")).alias("signature"))
    sizes = staged(keys.groupBy("signature").agg(F.count("*").alias("size")).filter("size > 1"))
    few = min(FEW_SETS, block)
    # No list here is longer than FEW_SETS.
    met = keys.join(sizes.filter(F.col("size") <= few).select("signature"), "signature").groupBy("signature").agg(
        F.collect_list(F.struct("set_id", "n", "own_kind")).alias("held")
    )
    pairs = met.select("held", F.explode("held").alias("x")).select("x", F.explode("held").alias("y")).filter(
        "x.set_id < y.set_id and abs(x.own_kind - y.own_kind) <= 1"
    ).select(F.col("x.set_id").alias("a"), F.col("y.set_id").alias("b"), F.least("x.n", "y.n").alias("low"), F.greatest("x.n", "y.n").alias("high"))
    # A near pair has so many keys in common; if one of them has many sets, the pair is met below.
    often = pairs.filter(F.col("low") >= F.col("high") * threshold - 1e-9).groupBy("a", "b", "low", "high").agg(
        F.count("*").alias("common")
    ).filter(F.col("common") >= F.least(F.lit(IN_COMMON), F.ceil(F.col("low") * threshold - 1e-9)))
    left, right = (sets.select(F.col("set_id").alias(x), F.col("signatures").alias(f"{x}_set")) for x in "ab")
    both = F.size(F.array_intersect("a_set", "b_set"))
    near = often.join(left, "a").join(right, "b").filter(both / (F.col("low") + F.col("high") - both) >= threshold)
    near = staged(near.select("a", "b"))
    hot = staged(
        keys.join(sizes.filter(F.col("size") > few), "signature")
        .withColumn("kind", F.explode(F.array(F.col("own_kind"), F.col("own_kind") + 1)))
        .select("set_id", "signature", "kind", "size")
    )
    # Each set first meets the others under one key only, the one of fewest sets; copies of a text find each other there.
    one = hot.groupBy("set_id").agg(F.min(F.struct("size", "signature")).alias("least")).select("set_id", "least.signature")
    early = staged(_within_keys(hot.join(one, ["set_id", "signature"]), sets, threshold, block))
    joined = staged(components(near.union(early), "a", "b"))
    parts = hot.join(joined, F.col("set_id") == F.col("node"), "left").select(
        "set_id", "signature", "kind", F.coalesce("component", "set_id").alias("part")
    )
    # Keys whose sets are all joined by now have nothing more to tell.
    open_keys = parts.groupBy("signature", "kind").agg(F.min("part").alias("first"), F.max("part").alias("last")).filter("first < last")
    late = _within_keys(parts.join(open_keys.select("signature", "kind"), ["signature", "kind"]), sets, threshold, block)
    return near.union(early).union(late).distinct()


def _within_keys(rows: DataFrame, sets: DataFrame, threshold: float, block: int) -> DataFrame:
    """Links a, b between sets under one key (signature, kind); those of one ``part``, if given, need none.

    A key is dealt to pairs of blocks; each pair is one row group, read in order.
    """
    if "part" not in rows.columns:
        rows = rows.withColumn("part", F.col("set_id"))
    # Keys of the same sets are looked at once.
    at = ["signature", "kind"]
    held = rows.groupBy(*at).agg(
        F.count("*").alias("held"), F.bit_xor(F.xxhash64("set_id")).alias("one"), F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("two")
    ).filter("held > 1")
    many = held.groupBy("held", "one", "two").agg(F.min(F.struct(*at)).alias("at")).select("held", "at.*")
    blocks = F.ceil(F.col("held") / block).cast("int")
    own = F.pmod(F.xxhash64("set_id"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    dealt = rows.join(many, at).select("set_id", "part", "signature", "kind", own.alias("own"), other.alias("other"))
    placed = dealt.select(
        "set_id", "part", "signature", "kind", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    ).join(sets, "set_id")
    key = ["signature", "kind", "low", "high"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (row for part in slices(batches) for row in zip(*(c.to_pylist() for c in part.columns)))
        for _, group in groupby(lines, key=itemgetter(0, 1, 2, 3)):
            held = sorted(((len(s), i, part, np.array(s)) for *_, i, part, s in group), key=itemgetter(0, 1))
            links = spanning_links([s for *_, s in held], threshold, [part for _, _, part, _ in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array([held[i][1] for i, _ in links], pa.int64()), pa.array([held[j][1] for _, j in links], pa.int64())], names=["a", "b"]
            )

    found = placed.select(*key, "set_id", "part", "signatures").repartition(*key).sortWithinPartitions(*key)
    return found.mapInArrow(run, "a bigint, b bigint")


def _prefix(n: int, threshold: float) -> int:
    """Of two near sets' rarest signatures, so many of each have IN_COMMON in common, or all that must be if that is less."""
    least = ceil(n * threshold - 1e-9)
    return n - least + min(IN_COMMON, least)


def spanning_links(sets: list[np.ndarray], threshold: float, parts: list[int] | None = None) -> list[tuple[int, int]]:
    """Links of a spanning forest of sets in order of length, by pruned Jaccard; sets of one part are joined from the start."""
    first = {part: i for i, part in reversed(list(enumerate(parts or [])))}
    root = [first[part] for part in parts] if parts else list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links, held = [], [frozenset(s.tolist()) for s in sets]
    for i, shorter in enumerate(held):
        for j in range(i + 1, len(held)):
            if len(shorter) < threshold * len(held[j]) - 1e-9:
                break
            if find(i) != find(j):
                common = len(shorter & held[j])
                if common / (len(shorter) + len(held[j]) - common) >= threshold:
                    root[find(i)] = find(j)
                    links.append((i, j))
    return links


def near_groups(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, fingerprint and class_id, the least doc_id that links lead to, for every document."""
    prints, labelled = _classes(documents.select("doc_id", "text"), [], threshold)
    fingerprint = F.array_join(F.transform("signatures", lambda x: F.lpad(F.lower(F.hex(x.cast("bigint").bitwiseAND(2**32 - 1))), 8, "0")), "")
    return prints.join(labelled, "set_id").select("doc_id", fingerprint.alias("fingerprint"), "class_id")


def _classes(documents: DataFrame, keep: list[str], threshold: float) -> tuple[DataFrame, DataFrame]:
    """set_id and the kept columns of every document, with its signatures if nothing is kept; class_id by set_id."""

    def make():
        return lambda text: signatures(text or "").view("i4").tolist()

    made = with_value(documents, ["text"], make, "signatures", "array<int>")
    prints = staged(made.select(*keep, "doc_id", "signatures", F.xxhash64("signatures").alias("set_id")))
    sets = staged(prints.groupBy("set_id").agg(F.first("signatures").alias("signatures"), F.min("doc_id").alias("least")))
    if keep:  # the signatures are not wanted twice
        whole, prints = prints, staged(prints.select("set_id", *keep))
        forget(whole)
    links = staged(set_links(sets.select("set_id", "signatures"), threshold))
    found = staged(components(links, "a", "b"))
    labelled = sets.join(found, F.col("set_id") == F.col("node"), "left").select(
        "set_id", "least", F.coalesce("component", "set_id").alias("component")
    )
    ids = labelled.groupBy("component").agg(F.min("least").alias("class_id"))
    classes = staged(labelled.join(ids, "component").select("set_id", "class_id"))
    forget(sets, links)
    return prints, classes
