"""Bulk-synchronous best-fit packing of token sequences.

Documents are tokenized and cut: a document longer than the capacity gives full
pieces and one shorter piece at its start. Pieces and the gaps of the open
sequences are held sorted by length. In each round all waiting pieces look up
their successor, the smallest gap that holds them; where several lengths claim
the same gaps the longer ones come first, and pieces of one length take gaps by
their rank; then gaps are updated and the next round begins. Where the longest
waiting pieces find no gap, new sequences are opened for them.

Lengths and gaps lie between 1 and the capacity, so the sorted order of all
pieces is their histogram: at most ``capacity`` runs of equal length. The sweeps
work on these runs, whatever the number of documents; placing the pieces by
their rank within a run, and ranking them, is done by Spark over all rows. The
number of rounds and of runs depends on the capacity alone.

Defined cases: a null text is an empty one and becomes a piece of the end token
alone; repeated rows are packed like any others; rows with a null id stay; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clipsense.llm.numbering import buckets_for, running
from clipsense.llm.texts import slices
from clipsense.session import staged

CAPACITY = 2048
END_TOKEN = 0
#: Chunks of text whose ids a task remembers at most.
REMEMBERED = 800_000

#: length, first rank, pieces, pieces a sequence, first sequence, offset of the first piece
Move = tuple[int, int, int, int, int, int]

#: A place where a byte-level tokenizer always begins anew: no pattern takes a
#: blank into the middle of a token, nor white space together with what follows.
_BREAK = re.compile(r"(?<=\S) (?=\S)")


def byte_bpe_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_pairs(tokenizer: Tokenizer) -> tiktoken.Encoding:
    """The tokenizer's vocabulary in the library that merges new words fastest; its ids are in merge order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    # Bytes that are not printable stand in the vocabulary as the characters from 256 on.
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {token.content for token in tokenizer.get_added_tokens_decoder().values()}
    ranks = {
        bytes(byte_of[c] for c in token): i for token, i in tokenizer.get_vocab().items() if token not in special
    }
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def chunk_encoder(tokenizer_path: str) -> Callable[[str], bytes]:
    """A function from text to its ids as little-endian 32-bit numbers.

    The text is cut at single blanks between other characters, where the
    tokenizer begins anew anyway, and the ids of chunks are remembered, for all
    tasks of a worker.
    """
    tokenizer = Tokenizer.from_file(tokenizer_path)
    split = json.loads(tokenizer.pre_tokenizer.__getstate__()) if tokenizer.pre_tokenizer else {}
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or tokenizer.normalizer is not None:
        raise ValueError("chunks are only known to be independent for a plain byte-level tokenizer")
    known: dict[str, bytes] = {}

    pair_merger = byte_pairs(tokenizer)

    def ids_of(texts: list[str]) -> list[bytes]:
        found = map(pair_merger.encode_ordinary, texts)
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in found]

    def encode(text: str) -> bytes:
        first, *rest = text.split(" ")
        last: list[str] = []
        ids = list(map(known.get, rest))
        new = list(dict.fromkeys(chunk for chunk, found in zip(rest, ids) if found is None))
        if not (first and _whole(first) and all(map(_whole, new))):
            # White space side by side: break only where it is sure, and do not remember an open end.
            first, *rest = _BREAK.split(text)
            rest, last = rest[:-1], rest[-1:]
            ids = list(map(known.get, rest))
            new = list(dict.fromkeys(chunk for chunk, found in zip(rest, ids) if found is None))
        if new:
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = list(dict.fromkeys(rest))
            known.update(zip(new, ids_of([f" {chunk}" for chunk in new])))
            ids = [known[chunk] for chunk in rest]
        ends = ids_of([first, *[f" {chunk}" for chunk in last]])
        return b"".join([ends[0], *ids, *ends[1:]])

    return encode


def _whole(chunk: str) -> bool:
    """Whether the chunk neither is empty nor begins or ends with white space."""
    return chunk != "" and not chunk[0].isspace() and not chunk[-1].isspace()


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces: full ones, and a shorter one before them."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *[(at, capacity) for at in range(first, length, capacity)]]


def token_pieces(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """A row for each piece of each document: place, length, crc32 and, if asked for, the ids."""
    fields = [
        ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
        ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = chunk_encoder(tokenizer_path)
        end = END_TOKEN.to_bytes(4, "little")
        for part in slices(batches):
            rows = []
            for doc_id, text, text_hash in zip(*(c.to_pylist() for c in part.columns)):
                ids = encode(text or "") + end
                for piece, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, text_hash, piece, start, length, zlib.crc32(own))
                    rows.append((*row, struct.unpack(f"<{length}I", own)) if with_ids else row)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    ddl = "doc_id bigint, text_hash bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, ddl + ", ids array<int>" * with_ids
    )


def best_fit(histogram: dict[int, int], capacity: int) -> list[Move]:
    """Rounds of successor sweeps over runs of equal lengths and runs of equal gaps."""
    waiting = dict(sorted(((n, c) for n, c in histogram.items() if c), reverse=True))
    placed: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = {}
    moves: list[Move] = []
    opened = 0

    def put(length: int, sequences: int, each: int, first: int, gap: int, into: dict[int, list[tuple[int, int]]]) -> None:
        moves.append((length, placed[length], sequences * each, each, first, capacity - gap))
        placed[length] += sequences * each
        waiting[length] -= sequences * each
        if gap - each * length:
            into.setdefault(gap - each * length, []).append((first, sequences))

    while waiting:
        # Sweep: all lengths, the longest first, against the gaps as they stand.
        order = sorted(gaps)
        claims: dict[int, list[int]] = {}
        homeless = []
        for length in waiting:
            at = bisect_left(order, length)
            if at < len(order):
                claims.setdefault(order[at], []).append(length)
            else:
                homeless.append(length)
        # Resolve: longer pieces first, then by rank; update the gaps.
        later: dict[int, list[tuple[int, int]]] = {}
        for gap, lengths in claims.items():
            runs = gaps.pop(gap)
            for length in lengths:
                while runs and waiting[length]:
                    first, n = runs.pop()
                    taken = min(n, waiting[length])
                    put(length, taken, 1, first, gap, later)
                    if taken < n:
                        runs.append((first + taken, n - taken))
            if runs:
                later.setdefault(gap, []).extend(runs)
        for gap, runs in later.items():
            gaps.setdefault(gap, []).extend(runs)
        # Open sequences for the longest pieces without a gap; two pieces over half the capacity never share one.
        for at, length in enumerate(homeless):
            if at and 2 * length <= capacity:
                break
            each = min(capacity // length, waiting[length])
            sequences, rest = divmod(waiting[length], each)
            put(length, sequences, each, opened, capacity, gaps)
            opened += sequences
            if rest:
                put(length, 1, rest, opened, capacity, gaps)
                opened += 1
        waiting = {length: n for length, n in waiting.items() if n}
    return moves


def pack(
    documents: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    spark = documents.sparkSession
    pieces = staged(token_pieces(documents, tokenizer_path or byte_bpe_path(), capacity, with_ids))
    # At most ``capacity`` rows, one for each length.
    histogram = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    moves = best_fit(histogram, capacity)
    runs = spark.createDataFrame(
        moves or [(0, 0, 0, 1, 0, 0)], "run_length long, rank_from long, n long, each long, sequence_from long, place long"
    )
    ranked = running(
        pieces, ["length"], ["doc_id", "text_hash", "piece"], F.lit(1), "rank", buckets_for(sum(histogram.values()))
    )
    in_run = F.col("rank") - F.col("rank_from")
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return (
        # The runs number by the capacity, not by the documents.
        ranked.join(
            F.broadcast(runs),
            (F.col("length") == F.col("run_length")) & (in_run >= 0) & (in_run < F.col("n")),
        )
        .withColumn("sequence_id", F.col("sequence_from") + F.floor(in_run / F.col("each")))
        .withColumn("offset", F.col("place") + F.pmod(in_run, F.col("each")) * F.col("length"))
        .select(*own, "sequence_id", "offset", *["ids"] * with_ids)
    )
