"""Language ID by unigrams summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A
word's probability is the sum over all its segmentations into pieces, by the
forward algorithm; a text's is the product over its words. The language with
the highest one is predicted; the score is its share among all languages,
taken as equally likely beforehand.

The probabilities are fitted by expectation maximisation on at most
``SAMPLE_DOCS`` labelled documents of each language, taken in the order of a hash
of the id from those whose crc32(id) mod 5 is not 0, of each the first
``SAMPLE_CHARS`` characters; long words are fitted in overlapping stretches. Everything else covers all
documents. What is sent to the tasks is one number for each piece and language.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and
so is every text if nothing could be learned; characters outside the vocabulary
have the same probability in all languages; ties go to the language first in
order; a null id counts as held out; repeated rows get equal results; further
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipsense.llm.texts import per_row, split_words, with_value
from clipsense.llm.unigram import marked, matcher, piece_vocabulary_path

UNDETERMINED = "und"
FOLDS = 5
#: The most labelled documents of a language that the fit uses, and its rounds.
SAMPLE_DOCS = 200
ROUNDS = 3
#: Pseudo-count of every piece, and probability of a character outside the vocabulary.
SMOOTHING = 0.1
OUTSIDE = 1e-7
#: Longer words are summed with rescaling, and fitted in stretches of that length which overlap.
LONG_WORD = 40
OVERLAP = 16
#: Characters of a sample document that the fit reads.
SAMPLE_CHARS = 50_000
SMALL = 1e-150
#: Numbers that a worker remembers for words at most.
REMEMBERED = 3_200_000


def lettered(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


@lru_cache(maxsize=2)
def vocabulary_size(path: str) -> int:
    return 1 + max(i for _, i, _ in matcher(path).values())


def matches(word: str, path: str) -> list[tuple[int, int, int]]:
    """end, start and piece of every piece in the word by ends; piece -1 for a character outside."""
    found = [(last + 1, last + 1 - length, i) for last, (length, i, _) in matcher(path).iter(word)]
    single = {end for end, start, _ in found if end - start == 1}
    if len(single) < len(word):
        found = sorted([*found, *[(end, end - 1, -1) for end in range(1, len(word) + 1) if end not in single]])
    return found


def forward(word: str, tables: list[list[float]], path: str) -> list[float]:
    """Log probability of a marked word in each language; a table ends with the probability of outside characters."""
    found = matches(word, path)
    if len(word) > LONG_WORD:
        return [_rescaled(word, found, table) for table in tables]
    sums = []
    for table in tables:
        f = [1.0, *[0.0] * len(word)]
        for end, start, i in found:
            f[end] += f[start] * table[i]
        sums.append(log(f[-1]))
    return sums


def _rescaled(word: str, found: list[tuple[int, int, int]], table: list[float]) -> float:
    f, shift, done = [1.0, *[0.0] * len(word)], 0.0, 0
    longest = max(end - start for end, start, _ in found)
    for end, start, i in found:
        if end != done and 0.0 < f[done] < SMALL:
            for j in range(max(0, done - longest), done + 1):
                f[j] /= SMALL
            shift += log(SMALL)
        done = end
        f[end] += f[start] * table[i]
    return log(f[-1]) + shift


def stretches(word: str) -> list[str]:
    """A long word in stretches that overlap, so that a piece across a cut is whole in one of them."""
    if len(word) <= LONG_WORD:
        return [word]
    return [word[at : at + LONG_WORD] for at in range(0, len(word) - OVERLAP, LONG_WORD - OVERLAP)]


def fit(counts: Counter, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities from word counts: each round takes expected uses of pieces over all segmentations."""
    size = vocabulary_size(path)
    table = [1.0 / size] * size + [OUTSIDE]
    words = [(part, n, matches(part, path)) for word, n in sorted(counts.items()) for part in stretches(marked(word))]
    for _ in range(rounds):
        uses = np.full(size + 1, SMOOTHING)
        for word, n, found in words:
            f, b = [1.0, *[0.0] * len(word)], [*[0.0] * len(word), 1.0]
            for end, start, i in found:
                f[end] += f[start] * table[i]
            for end, start, i in reversed(found):
                b[start] += b[end] * table[i]
            for end, start, i in found:
                uses[i] += n * f[start] * table[i] * b[end] / f[-1]
        uses = uses[:size]
        table = (uses / uses.sum()).tolist() + [OUTSIDE]
    return np.array(table)


def train(documents: DataFrame, path: str, sample_docs: int = SAMPLE_DOCS) -> tuple[list[str], np.ndarray]:
    """The languages in order, and a row of piece probabilities for each."""
    labelled = documents.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    sample = labelled.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= sample_docs).select("lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"))

    def fitted(table: pa.Table) -> pa.Table:
        counts = Counter(word for text in table.column("text").to_pylist() for word in split_words(text))
        return pa.table({"lang": table.column("lang")[:1].combine_chunks(), "table": pa.array([fit(counts, path).tobytes()])})

    rows = sorted(sample.groupBy("lang").applyInArrow(fitted, "lang string, table binary").collect())
    return [row["lang"] for row in rows], np.array([np.frombuffer(row["table"]) for row in rows])


def predictor(spark: SparkSession, languages: list[str], tables: np.ndarray, path: str) -> Callable:
    """What a task calls to get a function from a text to its language and score."""
    shared = spark.sparkContext.broadcast((languages, tables))

    def make() -> Callable[[str | None], tuple[str, float]]:
        names, numbers = shared.value
        probabilities = [row.tolist() for row in numbers]
        known: dict[str, int] = {}
        most = max(1, REMEMBERED // max(1, len(names)))
        logs = np.empty((min(most, 1024), len(names)))

        def number(word: str) -> int:
            nonlocal logs
            if len(known) == len(logs):
                logs = np.concatenate([logs, np.empty_like(logs)])
            at = known[word] = len(known)
            logs[at] = forward(marked(word), probabilities, path)
            return at

        def apply(text: str | None) -> tuple[str, float]:
            if not names or not lettered(text):
                return UNDETERMINED, 0.0
            if len(known) >= most:
                known.clear()
            words = split_words(text)
            at = [known[word] if word in known else number(word) for word in words]
            total = logs[at].sum(axis=0)
            top = int(total.argmax())
            return names[top], 1.0 / float(np.exp(total - total[top]).sum())

        return apply

    return make


def identify(documents: DataFrame, vocabulary_path: str | None = None, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, by a fit on those that are not held out."""
    path = vocabulary_path or piece_vocabulary_path()
    make = predictor(documents.sparkSession, *train(documents, path, sample_docs), path)

    def rows() -> Callable[..., tuple]:
        apply = make()
        return lambda doc_id, text, held: (doc_id, held, *apply(text))

    return per_row(
        documents.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), ["doc_id", "text", "held_out"],
        rows, "doc_id bigint, held_out boolean, lang_pred string, score double",
    )


def determined(documents: DataFrame, vocabulary_path: str | None = None, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The documents, with all columns, whose language can be told; all with a letter if no language was learned."""
    path = vocabulary_path or piece_vocabulary_path()
    languages, tables = train(documents, path, sample_docs)
    make = predictor(documents.sparkSession, languages, tables, path)

    def told() -> Callable[[str | None], bool]:
        if not languages:
            return lettered
        apply = make()
        return lambda text: apply(text)[0] != UNDETERMINED

    rows = documents.select(F.struct(*[c for c in documents.columns if c != "text"]).alias("rest"), "text")
    kept = with_value(rows, ["text"], told, "told", "boolean").filter("told")
    return kept.select(*[F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in documents.columns])
