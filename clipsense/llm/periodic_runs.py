"""Periodic runs of words by string synchronising sets.

A run is a stretch of words that repeats with a smallest period q at least
twice and cannot be made longer. All runs of a text are found, scale by scale
(tau = 2, 4, 8, ...), each scale being responsible for 3 tau <= q < 6 tau:

1. A position is *synchronising* if the least hash of the tau-word windows that
   start at it or at one of the next tau positions belongs to the first or the
   last of them. That depends on the next 2 tau words alone, so equal contexts
   are chosen alike, and every tau positions in a row hold a chosen one, unless
   they lie in a region with a period of at most tau / 3. Windows in such
   regions take no part, which keeps chosen positions with equal contexts more
   than tau / 3 apart.
2. Two chosen positions with equal contexts, 3 tau to 6 tau apart, propose their
   distance as a period. Proposals are extended word by word, so hashes decide
   nothing but what is looked at.
3. A run whose period is itself highly periodic (period p <= tau / 3) may have
   no chosen position. It lies in two regions of period p next to each other,
   which earlier scales have found; the distances that bring their phases
   together are its possible periods.

Periods below 6 are read off directly. The texts of a batch are laid end to
end, with a word of its own after each, and searched together; longer scales
see only the texts that can hold such a period.

Defined cases: a null or empty text has no runs; a null id is kept; repeated
rows each give their own row; an empty table gives no rows; further columns
are ignored. A text is searched whole whatever its length; a task holds some
ten numbers for each word of its batch.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from clipsense.llm.texts import slices

#: A run has at least so many words.
LEAST_LENGTH = 12
#: Periods below are read off directly; three times the first scale.
SMALL_PERIODS = 6
#: Words of the texts that are searched together, but for longer texts.
BATCH_WORDS = 200_000

SCHEMA = "doc_id bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"

Runs = dict[tuple[int, int], int]
Edit = Callable[[int | None, list[bytes]], list[bytes]]

_HIGH = np.uint64(2**63)


def _mix(values: np.ndarray) -> np.ndarray:
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(32)
    return values


def _doubled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows twice as wide."""
    if len(hashes) <= width:
        return hashes[:0]
    return _mix(hashes[:-width] * np.uint64(0xD6E8FEB86659FD93) + hashes[width:])


def _reach(ids: np.ndarray, x: int, y: int) -> int:
    """How many words from x on equal those from y on, x < y."""
    done, step = 0, 32
    while step := min(step, len(ids) - y - done):
        differs = ids[x + done : x + done + step] != ids[y + done : y + done + step]
        at = int(differs.argmax())
        if differs[at]:
            return done + at
        done += step
        step = min(2 * step, 65_536)
    return done


def _reach_back(ids: np.ndarray, x: int, y: int) -> int:
    """How many words before x equal those before y, x < y."""
    done, step = 0, 32
    while step := min(step, x - done):
        differs = ids[x - done - step : x - done] != ids[y - done - step : y - done]
        at = int(differs[::-1].argmax())
        if differs[step - 1 - at]:
            return done + at
        done += step
        step = min(2 * step, 65_536)
    return done


def _small_periods(ids: np.ndarray, runs: Runs) -> None:
    for q in range(1, min(SMALL_PERIODS, len(ids))):
        same = np.zeros(len(ids) - q + 2, dtype=np.int8)
        same[1:-1] = ids[:-q] == ids[q:]
        edges = np.flatnonzero(np.diff(same))
        starts, ends = edges[::2], edges[1::2]
        for s, e in zip(starts[ends - starts >= q].tolist(), ends[ends - starts >= q].tolist()):
            runs.setdefault((s, e + q), q)


def _synchronising(windows: np.ndarray, tau: int, regions: list[tuple[int, int]]) -> np.ndarray:
    """The synchronising positions among windows of tau words; regions (start, end) are highly periodic."""
    key = windows >> np.uint64(1)
    if regions:
        depth = np.zeros(len(key) + 1, dtype=np.int32)
        starts, ends = np.array(regions).T
        np.add.at(depth, starts, 1)
        np.add.at(depth, np.minimum(ends - tau + 1, len(key)), -1)
        key[np.cumsum(depth[:-1]) > 0] = _HIGH
    least, width = key, 1
    while width <= tau:  # windows of 1, 2, 4, ... tau positions, then one of tau + 1
        shift = width if 2 * width <= tau + 1 else tau + 1 - width
        least = np.minimum(least[:-shift], least[shift:])
        width += shift
    chosen = (least < _HIGH) & ((key[: len(least)] == least) | (key[tau:] == least))
    return np.flatnonzero(chosen)


def _proposals(positions: np.ndarray, contexts: np.ndarray, tau: int) -> list[tuple[int, int]]:
    """(distance, position) of chosen positions with equal contexts, 3 tau to 6 tau apart, in order."""
    order = np.argsort(contexts, kind="stable")
    contexts, positions = contexts[order], positions[order]
    found = []
    for step in range(1, len(positions)):
        apart = positions[step:] - positions[:-step]
        near = (contexts[step:] == contexts[:-step]) & (apart < 6 * tau)
        if not near.any():
            break
        near &= apart >= 3 * tau
        found.append(np.stack([apart[near], positions[:-step][near]]))
    if not found:
        return []
    distances, starts = np.concatenate(found, axis=1)
    order = np.lexsort((starts, distances))
    return list(zip(distances[order].tolist(), starts[order].tolist()))


def _phase(ids: np.ndarray, s1: int, s2: int, p: int) -> int | None:
    """The shift, below p, that brings the period at s1 onto the region from s2 on."""
    word = ids.itemsize
    text, part = ids[s2 : s2 + 2 * p - 1].tobytes(), ids[s1 : s1 + p].tobytes()
    at = text.find(part)
    while at > 0 and at % word:
        at = text.find(part, at + 1)
    return None if at < 0 else (s2 + at // word - s1) % p


def _between_regions(ids: np.ndarray, tau: int, regions: list[tuple[int, int, int]], runs: Runs) -> None:
    """Runs of period 3 tau to 6 tau over two highly periodic regions (period, start, end) side by side."""
    for (p, s1, e1), (p2, s2, e2) in zip(regions, regions[1:]):
        if p2 != p or s2 > e1:
            continue
        phase = _phase(ids, s1, s2, p)
        if phase is None:
            continue
        for q in range(3 * tau + (phase - 3 * tau) % p, min(6 * tau, e1 - s1 + 1, e2 - s2 + 1), p):
            lo, hi = max(s1, s2 - q), min(e1, e2 - q)
            if hi - lo >= q:
                lo, hi = lo - _reach_back(ids, lo, lo + q), hi + _reach(ids, hi, hi + q)
                runs.setdefault((lo, hi + q), q)


def runs_of(ids: np.ndarray, longest: Callable[[int], int] | None = None) -> Runs:
    """Smallest period by (start, end) of every stretch that repeats at least twice and cannot be longer.

    ``longest(n)`` may say up to which place texts of n words and more reach.
    """
    runs: Runs = {}
    _small_periods(ids, runs)
    tau = 2
    narrow = _doubled(_mix(ids.astype(np.uint64)), 1)
    while True:
        end = longest(6 * tau) if longest else len(ids)
        if end < 6 * tau:
            return runs
        ids, narrow = ids[:end], narrow[: max(end - tau + 1, 0)]
        wide = _doubled(narrow, tau)
        known = sorted((p, s, e) for (s, e), p in runs.items() if 3 * p <= tau <= e - s and e <= end)
        positions = _synchronising(narrow, tau, [(s, e) for _, s, e in known])
        last, matched = 0, 0
        for q, at in _proposals(positions, wide[positions], tau):
            if q == last and at < matched:
                continue
            lo = at - _reach_back(ids, at, at + q)
            last, matched = q, at + _reach(ids, at, at + q)
            if matched - lo >= q:
                runs.setdefault((lo, matched + q), q)
        _between_regions(ids, tau, [r for r in known if r[2] - r[1] >= 3 * tau], runs)
        narrow, tau = wide, 2 * tau


def runs_of_texts(texts: list[list[bytes]], least: int = LEAST_LENGTH) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each text's runs, by start, then period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(texts[i]) for i in order], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    ids = np.empty(int(starts[-1]), dtype=np.int64)
    for k, i in enumerate(order):
        ids[starts[k] : starts[k + 1] - 1] = [numbers[w] for w in texts[i]]
    ids[starts[1:] - 1] = -1 - np.arange(len(order))  # a word of its own after each text
    falling = -sizes
    found = runs_of(ids, lambda n: int(starts[np.searchsorted(falling, -n, side="right")]))
    result: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    kept = [(s, e - s, q) for (s, e), q in found.items() if e - s >= least]
    places = np.searchsorted(starts, [s for s, _, _ in kept], side="right") - 1
    for (s, n, q), k in zip(kept, places.tolist()):
        result[order[k]].append((s - int(starts[k]), n, q))
    for row in result:
        row.sort(key=lambda r: (r[0], r[2]))
    return result


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that lie in a run after its first period."""
    if not runs:
        return b" ".join(words)
    gone = bytearray(len(words))
    for s, n, q in runs:
        gone[s + q : s + n] = b"\x01" * (n - q)
    return b" ".join(w for w, g in zip(words, gone) if not g)


def _in_batches(part: pa.RecordBatch, edit: Edit | None) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of some rows at a time."""
    ids, texts, total = [], [], 0
    for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
        words = (text or "").encode().split()
        words = edit(doc_id, words) if edit else words
        if texts and total + len(words) > BATCH_WORDS:
            yield ids, texts
            ids, texts, total = [], [], 0
        ids.append(doc_id)
        texts.append(words)
        total += len(words)
    if texts:
        yield ids, texts


def find_runs(documents: DataFrame, least: int = LEAST_LENGTH, edit: Edit | None = None) -> DataFrame:
    """doc_id, the runs of each text, and the text with every run cut to its first period.

    ``edit(doc_id, words)`` may change the words before they are searched.
    """
    arrow = to_arrow_schema(StructType.fromDDL(SCHEMA))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            for ids, texts in _in_batches(part, edit):
                runs = runs_of_texts(texts, least)
                rows = [[{"start": s, "length": n, "period": q} for s, n, q in row] for row in runs]
                left = [collapsed(words, row).decode() for words, row in zip(texts, runs)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, arrow[0].type), pa.array(rows, arrow[1].type), pa.array(left, arrow[2].type)], schema=arrow
                )

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)
