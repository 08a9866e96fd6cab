"""Substring deduplication by suffix automata of reference shards.

A window is ``WINDOW`` consecutive words of a document. Words in a window whose
sequence also starts in a document with a smaller id are removed; windows are
judged on the input, not on what is left.

The reference are the documents themselves, so automata of all of it, sent to
all tasks, would cost the square of the corpus. The reference is therefore cut
into shards by content, and a shard's automaton meets just the passages that
can match in it: each window is assigned to the least hash among its runs of
``ANCHOR`` words. Equal windows have equal anchors, so a shard is what the
documents have at one anchor: the passages of windows assigned to it, each
different passage once, with the least id that has it. Only anchors found in
two documents go on.

In a shard, a suffix automaton is built over its passages, each state with the
least id among the places where its strings end. Every passage is streamed
through it; where the matching statistic reaches the window, the state of the
last ``WINDOW`` words tells the first document that has them. Those answers go
back to all documents that have the passage, overlapping windows become spans,
and the spans are cut out.

A shard of more than ``SHARD`` different passages (a phrase shorter than a
window, very common and always among other words) would be a hot group. Its
passages are split into single windows, each window its own shard with one
passage, grouped by a 64-bit hash of its words.

Defined cases: a null or short text loses nothing; a null id counts as the
largest; repeated rows with one id are one document and do not remove each
other; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsense.llm.texts import per_row, slices
from clipsense.session import staged

WINDOW = 50
#: Words of an anchor.
ANCHOR = 12
#: Windows of a passage at most, so that its length is bounded.
RUN = 64
#: Different passages of a shard that one automaton holds.
SHARD = 256
#: Bytes of text hashed at once.
BLOCK = 1 << 20
LAST = 2**63 - 1

_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BYTE = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


class Powers:
    """The powers of an odd number and of its inverse modulo 2 ** 64, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, f)])) for f in (_STEP, _BACK))


_POWERS = Powers()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of the values, the same wherever it stands."""
    _POWERS.reach(len(values) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * _POWERS.up[: len(values)])])
    return _mixed((sums[ends] - sums[starts]) * _POWERS.down[starts])


def word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words of a text, in order."""
    found = []
    at = 0
    while at < len(data):
        end = min(len(data), at + BLOCK)
        while end < len(data) and not _WHITE[data[end]]:
            end += 1
        block = np.frombuffer(data, dtype=np.uint8, count=end - at, offset=at)
        inside = np.concatenate([[False], ~_WHITE[block], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        found.append(range_hashes(_BYTE[block], edges[::2], edges[1::2]))
        at = end
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def passages(words: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, ...]:
    """anchor, first word, windows and hash of each passage; ``document`` tells the words' documents apart."""
    starts = np.arange(max(0, len(words) - WINDOW + 1))
    runs = range_hashes(words, np.arange(max(0, len(words) - ANCHOR + 1)), np.arange(ANCHOR, max(ANCHOR, len(words) + 1)))
    width = WINDOW - ANCHOR + 1
    least = np.lib.stride_tricks.sliding_window_view(runs, width).min(axis=1) if len(starts) else runs[:0]
    whole = document[starts] == document[starts + WINDOW - 1]
    starts, least = starts[whole], least[whole]
    if not len(starts):
        return (np.empty(0, dtype=np.uint64), starts, starts, np.empty(0, dtype=np.uint64))
    cut = (starts[1:] != starts[:-1] + 1) | (least[1:] != least[:-1]) | (document[starts[1:]] != document[starts[:-1]])
    first = np.concatenate([[0], np.flatnonzero(cut) + 1])
    number = np.cumsum(np.concatenate([[0], cut]))
    # Long runs, as of one word again and again, are cut.
    within = np.arange(len(starts)) - first[number]
    first = np.flatnonzero(within % RUN == 0)
    n = np.diff(np.concatenate([first, [len(starts)]]))
    begin = starts[first]
    return least[first], begin, n, range_hashes(words, begin, begin + n + WINDOW - 1)


def occurrences(documents: DataFrame) -> DataFrame:
    """anchor, passage, row, doc, first, windows for every passage of every document."""
    names = ["anchor", "passage", "row", "doc", "first", "windows"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [text.encode() for text in part.column(2).to_pylist()]
            row, doc = (part.column(i).to_numpy() for i in (0, 1))
            at = 0
            while at < len(texts):
                end, size = at + 1, len(texts[at])
                while end < len(texts) and size + len(texts[end]) <= BLOCK:
                    size += len(texts[end])
                    end += 1
                words = [word_hashes(text) for text in texts[at:end]]
                counts = np.array([len(w) for w in words])
                document = np.repeat(np.arange(at, end), counts)
                anchor, first, windows, passage = passages(np.concatenate(words), document)
                own = document[first]
                before = np.concatenate([[0], np.cumsum(counts)])[own - at]
                yield pa.RecordBatch.from_arrays([
                    pa.array(anchor.view("i8")), pa.array(passage.view("i8")), pa.array(row[own]), pa.array(doc[own]),
                    pa.array((first - before).astype("i4")), pa.array(windows.astype("i4")),
                ], names=names)
                at = end

    return documents.select("row", "doc", "text").mapInArrow(
        run, "anchor bigint, passage bigint, row bigint, doc bigint, first int, windows int"
    )


class SuffixAutomaton:
    """All stretches of some word sequences; each state has the least id where its strings end."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], [LAST]

    def add(self, words: list[str], doc: int) -> None:
        following, link, length, least = self.next, self.link, self.length, self.least
        last = 0
        for word in words:
            known = following[last].get(word)
            if known is not None and length[known] == length[last] + 1:
                last = known
                least[last] = min(least[last], doc)
                continue
            if known is not None:
                last = self._split(last, word, known)
                least[last] = min(least[last], doc)
                continue
            new, at = len(following), last
            following.append({})
            length.append(length[last] + 1)
            least.append(doc)
            link.append(0)
            while at >= 0 and word not in following[at]:
                following[at][word] = new
                at = link[at]
            if at >= 0:
                known = following[at][word]
                link[new] = known if length[known] == length[at] + 1 else self._split(at, word, known)
            last = new

    def _split(self, at: int, word: str, known: int) -> int:
        """A state of its own for the strings of ``known`` that are as short as a step from ``at``."""
        following, link = self.next, self.link
        new = len(following)
        following.append(dict(following[known]))
        self.length.append(self.length[at] + 1)
        self.least.append(LAST)
        link.append(link[known])
        link[known] = new
        while at >= 0 and following[at].get(word) == known:
            following[at][word] = new
            at = link[at]
        return new

    def close(self) -> None:
        """Give each state the least id of the states that end with its strings."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            self.least[up] = min(self.least[up], self.least[state])

    def first_with(self, words: list[str], window: int) -> list[int]:
        """For each window of a text, the least id that has it, or ``LAST``."""
        found, state, matched = [], 0, 0
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            while state and self.length[self.link[state]] >= window:
                state = self.link[state]
                matched = self.length[state]
            if i >= window - 1:
                found.append(self.least[state] if matched >= window else LAST)
        return found


def runs_of(firsts: list[int]) -> list[tuple[int, int, int]]:
    """from, windows and first document for stretches of windows with the same answer."""
    found, at = [], 0
    for first, own in groupby(firsts):
        n = len(list(own))
        found.append((at, n, first))
        at += n
    return found


ANSWER = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("first_doc", pa.int64())]))
ANSWERS = "anchor bigint, passage bigint, answers array<struct<at: int, n: int, first_doc: bigint>>"


def shard_answers(texts: DataFrame) -> DataFrame:
    """anchor, passage and answers; ``texts`` has anchor, passage, doc, words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for part in slices(batches) for row in zip(*(c.to_pylist() for c in part.columns)))
        anchors, keys, answers = [], [], []

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(anchors, pa.int64()), pa.array(keys, pa.int64()), pa.array(answers, ANSWER)],
                names=["anchor", "passage", "answers"],
            )
            for column in (anchors, keys, answers):
                column.clear()
            return batch

        for anchor, shard in groupby(rows, key=itemgetter(0)):
            held = [(passage, doc, words.split(" ")) for _, passage, doc, words in shard]
            automaton = SuffixAutomaton()
            for _, doc, words in held:
                automaton.add(words, doc)
            automaton.close()
            for passage, _, words in held:
                anchors.append(anchor)
                keys.append(passage)
                answers.append([dict(zip(("at", "n", "first_doc"), x)) for x in runs_of(automaton.first_with(words, WINDOW))])
            if len(keys) >= 4096:
                yield out()
        yield out()

    return texts.select("anchor", "passage", "doc", "words").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        run, ANSWERS
    )


def window_answers(texts: DataFrame) -> DataFrame:
    """The same for the passages of hot shards: every window is a shard with one passage."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            for anchor, passage, doc, words in zip(*(c.to_pylist() for c in part.columns)):
                hashed = word_hashes(words.encode())
                starts = np.arange(len(hashed) - WINDOW + 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(starts), anchor)), pa.array(np.full(len(starts), passage)),
                    pa.array(starts.astype("i4")), pa.array(np.full(len(starts), doc)),
                    pa.array(range_hashes(hashed, starts, starts + WINDOW).view("i8")),
                ], names=["anchor", "passage", "at", "doc", "window"])

    windows = staged(texts.select("anchor", "passage", "doc", "words").mapInArrow(
        run, "anchor bigint, passage bigint, at int, doc bigint, window bigint"
    ))
    # Written by itself, so that the join can split a window that very many passages have.
    firsts = staged(windows.groupBy("window").agg(F.min("doc").alias("first_doc")))
    # A passage has at most RUN windows.
    return windows.join(firsts, "window").groupBy("anchor", "passage").agg(
        F.sort_array(F.collect_list(F.struct("at", F.lit(1).alias("n"), "first_doc"))).alias("answers")
    )


def repeated_spans(documents: DataFrame) -> DataFrame:
    """row and spans: the stretches of words of each document that an earlier one has."""
    found = staged(occurrences(documents))
    shared = found.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high")
    hits = staged(found.join(shared.select("anchor"), "anchor", "left_semi"))
    distinct = staged(
        hits.groupBy("anchor", "passage").agg(F.min(F.struct("doc", "row", "first", "windows")).alias("own"))
        .select("anchor", "passage", "own.*")
    )
    sizes = distinct.groupBy("anchor").agg(F.count("*").alias("shard"))
    # A document has fewer passages than words.
    wanted = distinct.join(sizes, "anchor").groupBy("row").agg(
        F.first("doc").alias("doc"), F.collect_list(F.struct("anchor", "passage", "first", "windows", "shard")).alias("wanted")
    )

    def cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            rows = []
            for text, doc, wanted in zip(*(c.to_pylist() for c in part.columns)):
                words = text.encode().split()
                for w in wanted:
                    own = b" ".join(words[w["first"] : w["first"] + w["windows"] + WINDOW - 1]).decode()
                    rows.append((w["anchor"], w["passage"], doc, own, w["shard"]))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["anchor", "passage", "doc", "words", "shard"]
            )

    once = documents.select("row", "text").dropDuplicates(["row"])
    texts = staged(once.join(wanted, "row").select("text", "doc", "wanted").mapInArrow(
        cut_out, "anchor bigint, passage bigint, doc bigint, words string, shard bigint"
    ))
    ordinary, hot = texts.filter(F.col("shard") <= SHARD), texts.filter(F.col("shard") > SHARD)
    answers = shard_answers(ordinary).union(window_answers(hot))
    answered = hits.join(answers, ["anchor", "passage"]).select(
        "row", "doc", "first", F.explode("answers").alias("a")
    ).filter(F.col("a.first_doc") < F.col("doc"))
    start = F.col("first") + F.col("a.at")
    # The spans of a document, fewer than its words.
    return answered.select("row", start.alias("start"), (start + F.col("a.n") + WINDOW - 1).alias("end")).groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")
    )


def dedup(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words of every document, joined by blanks."""
    docs = documents.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(LAST)).alias("doc"),
    ).withColumn("row", F.xxhash64("doc", "text"))
    spans = repeated_spans(docs).withColumnRenamed("row", "_row")
    joined = docs.join(spans, F.col("row") == F.col("_row"), "left")

    def apply(doc_id: int | None, text: str, spans: list[dict] | None) -> tuple:
        words = text.encode().split()
        kept, at = [], 0
        for span in spans or ():
            kept += words[at : span["start"]] if span["start"] > at else []
            at = max(at, span["end"])
        kept += words[at:]
        return doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode()

    return per_row(joined, ["doc_id", "text", "spans"], lambda: apply, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def dedup_digests(documents: DataFrame) -> DataFrame:
    return dedup(documents).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
