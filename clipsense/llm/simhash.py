"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has a bit set where more than half of the XXH64 hashes of the
text's shingles have it. Two fingerprints that differ in at most three bits,
cut into two halves, have a half in which they differ in at most one bit: for
three bits one half has at most one of them. So each half is indexed under its
32 variants with one bit replaced by a wildcard, variants meet by an equality
join, and what meets is verified on the whole fingerprint.

Equal fingerprints are one node from the start. The fingerprints under one key
agree in 31 bits; where there are more than ``GROUP`` of them, each is indexed
again under the variants of its other 33 bits, cut the same way, and once more
if need be: after three levels at most 2 ** 11 fingerprints can share a key. A
group within that bound is compared in one task and gives a spanning forest of
its links, never all pairs.

Defined cases: a null text counts as empty; a text without words has the
fingerprint zero, one with fewer words than a shingle is one shingle; rows with
a null id take part in links, and a component of null ids alone has the id
null; repeated rows fall into one component; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsense.llm.components import components
from clipsense.llm.texts import slices
from clipsense.session import staged

SHINGLE = 3
SEED = 42
MOST_BITS = 3
ALL_BITS = 2**64 - 1
#: Fingerprints under one key that a task compares with each other.
GROUP = 2048
#: Hashes counted at once.
CHUNK = 65_536


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of the lower-cased words of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: len(words) - shingle].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), CHUNK):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], stops[at : at + CHUNK])], dtype="<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash and fp, the fingerprint as a signed number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = np.array([fingerprint(text, shingle) for text in part.column(2).to_pylist()], dtype="<u8")
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(found.view("<i8"))], names=["doc_id", "text_hash", "fp"]
            )

    return documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id bigint, text_hash bigint, fp bigint"
    )


def _variants(bits: list[int]) -> list[tuple[int, list[int]]]:
    """For free bit positions, each variant: the mask of bits its key keeps, and the bits still free."""
    half = len(bits) // 2
    found = []
    for own, other in ((bits[:half], bits[half:]), (bits[half:], bits[:half])):
        for wild in own:
            found.append((sum(1 << b for b in own if b != wild), sorted([*other, wild])))
    return found


@lru_cache(maxsize=None)
def _state(path: int) -> tuple[int, tuple[int, ...]]:
    """Mask and free bits after the variants of a path, one digit to the base 65 for each level."""
    if path == 0:
        return 0, tuple(range(64))
    mask, free = _state(path // 65)
    more, left = _variants(list(free))[path % 65 - 1]
    return mask | more, tuple(left)


def _key(fps: np.ndarray, mask: int) -> np.ndarray:
    """A hash of the mask and of what it keeps; should two keys meet, only more is compared."""
    x = (fps & np.uint64(mask)) + np.uint64(mask * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def index_variants(nodes: DataFrame) -> DataFrame:
    """Each fingerprint under the variants of what its path leaves free: key, fp, path."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 16_384):
            fp, path = part.column(0).to_numpy().view("u8"), part.column(1).to_numpy()
            for p in np.unique(path):
                own = fp[path == p]
                for v in range(len(_variants(list(_state(int(p))[1])))):
                    deeper = int(p) * 65 + v + 1
                    yield pa.RecordBatch.from_arrays([
                        pa.array(_key(own, _state(deeper)[0]).view("i8")), pa.array(own.view("i8")),
                        pa.array(np.full(len(own), deeper, dtype="i4")),
                    ], names=["key", "fp", "path"])

    return nodes.select("fp", "path").mapInArrow(run, "key bigint, fp bigint, path int")


def spanning_links(fps: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints at most ``most`` bits apart."""
    todo, links = np.arange(len(fps)), []
    while len(todo):
        front, todo = todo[:1], todo[1:]
        while len(front) and len(todo):
            near = np.bitwise_count(fps[front[:64], None] ^ fps[todo][None, :]) <= most
            hit = near.any(axis=0)
            links += zip(front[:64][near[:, hit].argmax(axis=0)].tolist(), todo[hit].tolist())
            front, todo = np.concatenate([front[64:], todo[hit]]), todo[~hit]
    return links


def link_fingerprints(nodes: DataFrame, group: int = GROUP) -> DataFrame:
    """Links a, b between distinct fingerprints, enough to connect all that are three bits apart or less."""
    level = nodes.select("fp", F.lit(0).alias("path"))
    links = None
    for depth in range(3):
        indexed = index_variants(level)
        if depth:
            # Two paths may lead to one mask.
            indexed = staged(indexed.groupBy("key", "fp").agg(F.min("path").alias("path")))
        counts = staged(indexed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
        last = depth == 2
        # The keys that several share grow with the documents: merged at every size, never broadcast.
        few, many = (counts.filter(c).hint("merge") for c in (F.lit(last) | (F.col("n") <= group), F.col("n") > group))
        found = _links_in_groups(indexed.join(few, "key", "left_semi"))
        links = found if links is None else links.union(found)
        if last or not many.take(1):
            break
        level = staged(indexed.join(many, "key", "left_semi").select("fp", "path"))
    return links.distinct()


def _links_in_groups(met: DataFrame) -> DataFrame:
    """Links among the fingerprints of each key; a task holds one key's at a time."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: list[tuple[int, int]] = []

        def out() -> pa.RecordBatch:
            ends = np.array(links, dtype="i8").reshape(-1, 2)
            links.clear()
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], names=["a", "b"])

        for _, found in groupby(rows(batches), key=itemgetter(0)):
            own = [fp for _, fp in found]
            if len(own) == 2:
                if ((own[0] ^ own[1]) & ALL_BITS).bit_count() <= MOST_BITS:
                    links.append((own[0], own[1]))
            else:
                fps = np.array(own, dtype="i8")
                links += [(own[i], own[j]) for i, j in spanning_links(fps.view("u8"), MOST_BITS)]
            if len(links) >= CHUNK:
                yield out()
        yield out()

    return met.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint")


def near_groups(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, fp, component and component_id, the least doc_id that links lead to, for every document."""
    prints = staged(fingerprints(documents, shingle))
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = staged(components(link_fingerprints(nodes), "a", "b"))
    labelled = nodes.join(found, nodes["fp"] == found["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), "least"
    )
    ids = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = labelled.join(ids, "component").select(F.col("fp").alias("_fp"), "component", "component_id")
    return prints.join(by_print, F.col("fp") == F.col("_fp")).drop("_fp")


def one_of_each(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The documents with the least id of their component, one row for each component, with all columns."""
    groups = near_groups(documents, shingle)
    kept = groups.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("own"))
    own = kept.select(F.col("own.doc_id").alias("kept_id"), F.col("own.text_hash").alias("kept_hash"))
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_hash"))
    return (
        rows.join(own, F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_hash") == F.col("kept_hash")), "left_semi")
        .dropDuplicates(["own_id", "own_hash"]).select("row.*")
    )
