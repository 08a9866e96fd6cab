"""Words against a fixed vocabulary of pieces: what the unigram operators share.

A word is written with the mark ``▁`` before it; pieces never cross words. Only
ordinary pieces take part, not control, byte or white-space pieces.

The public vocabulary file was made by merges and has the order of the merges in
place of unigram scores. A piece's score here is the log probability that the
law of Zipf and Mandelbrot gives to its place in that order: the r-th piece
has a share of 1 / (r + ``SHIFT``) of all, so that the shares add up to one. A
vocabulary file of unigram kind, whose scores are log probabilities already
(not all of them whole numbers), is taken as it is.
"""

from __future__ import annotations

from functools import lru_cache
from math import log

import ahocorasick
import public_tokenizers
from sentencepiece import SentencePieceProcessor

MARK = "▁"
SHIFT = 2.7


def piece_vocabulary_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[str, tuple[int, float]]:
    """Piece -> id and score, a log probability."""
    model = SentencePieceProcessor(model_file=path)
    found = {
        model.id_to_piece(i): (i, model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        and MARK not in model.id_to_piece(i)[1:]
    }
    if not all(score == int(score) for _, score in found.values()):
        return found
    order = sorted(found, key=lambda piece: (-found[piece][1], found[piece][0]))
    every = sum(1 / (place + SHIFT) for place in range(1, len(order) + 1))
    return {piece: (found[piece][0], -log((place + SHIFT) * every)) for place, piece in enumerate(order, 1)}


@lru_cache(maxsize=2)
def matcher(path: str) -> ahocorasick.Automaton:
    """Finds all pieces in a text, at each end the longest first; a match has its length, id and score."""
    automaton = ahocorasick.Automaton()
    for piece, (i, score) in vocabulary(path).items():
        automaton.add_word(piece, (len(piece), i, score))
    automaton.make_automaton()
    return automaton


def marked(word: str) -> str:
    """The word with the mark before it, as the public tokenizers write it."""
    return word if word.startswith(MARK) else MARK + word
