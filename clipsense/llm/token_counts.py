"""Count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton gives all vocabulary pieces that end at each place of
a word. For each place the best score of any segmentation so far and its number
of pieces are kept, nothing else: no path, no pieces. Ties follow the exact
rules of the public unigram tokenizer: starts are tried from left to right and
a later one must be strictly better, so of equal scores the longer last piece
wins; a place whose single character is no piece may also be reached by an
unknown piece, scored ten below the least piece, which is tried after the
pieces of the same start; unknown pieces side by side count as one.

Words do not share pieces, so counts of words add up to that of the text, and
each task remembers the words it has seen.

Defined cases: a null or empty text has no tokens; repeated rows get equal
results; rows with a null id stay; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from math import inf

from pyspark.sql import DataFrame

from clipsense.llm.texts import per_row, split_words
from clipsense.llm.unigram import marked, matcher, piece_vocabulary_path, vocabulary

#: The public tokenizer's distance of an unknown character below the least score.
UNKNOWN_PENALTY = 10.0
REMEMBERED = 800_000


@lru_cache(maxsize=2)
def word_counter(path: str) -> Callable[[list[str]], tuple[int, int]]:
    """A function from words to their tokens and the unknown ones among them."""
    automaton = matcher(path)
    unknown = min(score for _, score in vocabulary(path).values()) - UNKNOWN_PENALTY
    known: dict[str, tuple[int, int]] = {}

    singles = frozenset(piece for piece in vocabulary(path) if len(piece) == 1)

    def viterbi(word: str) -> tuple[int, int]:
        if not singles.issuperset(word):
            return with_unknowns(word)
        best, pieces = [0.0, *[-inf] * len(word)], [0] * (len(word) + 1)
        for last, (length, _, score) in automaton.iter(word):
            start = last + 1 - length
            total = best[start] + score
            if total > best[last + 1]:
                best[last + 1], pieces[last + 1] = total, pieces[start] + 1
        return pieces[-1], 0

    def with_unknowns(word: str) -> tuple[int, int]:
        matches: list[list[tuple[int, float]]] = [[] for _ in word]
        for last, (length, _, score) in automaton.iter(word):
            matches[last].append((length, score))
        # For each end: best score, pieces, unknown pieces, and whether the last one is unknown.
        best = [(0.0, 0, 0, False)]
        for end, found in enumerate(matches, 1):
            top = (-inf, 0, 0, False)
            for length, score in found:
                before = best[end - length]
                if before[0] + score > top[0]:
                    top = (before[0] + score, before[1] + 1, before[2], False)
            if word[end - 1] not in singles:
                before = best[end - 1]
                if before[0] + unknown > top[0]:
                    more = not before[3]
                    top = (before[0] + unknown, before[1] + more, before[2] + more, True)
            best.append(top)
        return best[-1][1:3]

    def count(words: list[str]) -> tuple[int, int]:
        tokens = unknowns = 0
        for word in words:
            found = known.get(word)
            if found is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = known[word] = viterbi(marked(word))
            tokens += found[0]
            unknowns += found[1]
        return tokens, unknowns

    return count


def count_tokens(documents: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """Words, tokens and unknown tokens of every document."""
    path = vocabulary_path or piece_vocabulary_path()

    def make() -> Callable[..., tuple]:
        count = word_counter(path)

        def apply(doc_id: int | None, text: str | None) -> tuple:
            words = split_words(text or "")
            return (doc_id, len(words), *count(words))

        return apply

    return per_row(documents, ["doc_id", "text"], make, "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint")
