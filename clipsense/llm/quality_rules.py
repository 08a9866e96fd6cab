"""Line-first quality rules.

Every line is judged by itself: punctuation (a long line without any sentence
mark, or one that is mostly marks), navigation (menus and tables of short cells
between separators) and boilerplate (fixed phrases). Failed lines are removed;
a document that loses too much of its text that way is rejected as a whole, unless
a single line of several is all it loses (a licence or a notice beside a short text).
Base counts of the whole text are returned besides.

Defined cases: a null text has no words and is not kept; lines without a word
are neither judged nor counted; repeated rows get equal results; rows with a
null id stay. The input may have any further columns.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

from clipsense.llm.texts import WHITE, per_row

#: Phrases that mark a line as boilerplate, in lower case: English, German, French, Spanish.
BOILERPLATE = (
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "forgot your password",
    "licensed under",
    "log in",
    "lorem ipsum",
    "permission is hereby granted",
    "privacy policy",
    "read more",
    "sign in",
    "sign up",
    "skip to content",
    "subscribe to",
    "terms of service",
    "terms of use",
    "use cookies",
    "alle rechte vorbehalten",
    "datenschutzerklärung",
    "hier klicken",
    "jetzt anmelden",
    "nutzungsbedingungen",
    "passwort vergessen",
    "verwendet cookies",
    "weiterlesen",
    "zum inhalt springen",
    "aller au contenu",
    "cliquez ici",
    "conditions générales",
    "lire la suite",
    "mentions légales",
    "mot de passe oublié",
    "politique de confidentialité",
    "tous droits réservés",
    "utilise des cookies",
    "aviso legal",
    "haga clic aquí",
    "iniciar sesión",
    "leer más",
    "política de privacidad",
    "saltar al contenido",
    "términos de uso",
    "todos los derechos reservados",
    "utiliza cookies",
)
SEPARATORS = frozenset(["|", ">", "»", "•", "·", "/", "::"])
SENTENCE_MARK = re.compile(r"[.,;:!?…。！？]")
SYMBOLS = "#*$%&|<>"
#: Lines of so many words need a sentence mark.
LONG_LINE = 12
#: The most symbols and exclamation marks for each word of a line.
MARKS_A_WORD = 0.5
#: The most separators for each word of a line.
SEPARATORS_A_WORD = 0.3
#: The share of its word characters that a document must keep.
LEAST_KEPT = 0.5

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, n_lines bigint, n_failed_lines bigint, "
    "kept_share double, cleaned string"
)


def line_fails(line: str, words: list[str]) -> str | None:
    """The rule a line with words breaks, or none."""
    n = len(words)
    marks = sum(line.count(mark) for mark in SYMBOLS) + line.count("!")
    if n >= 4 and sum(word in SEPARATORS for word in words) > SEPARATORS_A_WORD * n:
        return "navigation"
    if marks > MARKS_A_WORD * n and marks > 3:
        return "punctuation"
    if n >= LONG_LINE and not SENTENCE_MARK.search(line):
        return "punctuation"
    lower = line.lower()
    if any(phrase in lower for phrase in BOILERPLATE):
        return "boilerplate"
    return None


def repeated_words(words: list[str], size: int = 5) -> int:
    """Words in windows of ``size`` words that occur twice or more, the first included."""
    windows = list(zip(*(words[i:] for i in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, end = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + size - max(at, end)
            end = at + size
    return covered


def judge(doc_id: int | None, text: str | None) -> tuple:
    text = text or ""
    all_words: list[str] = []
    seen: set[str] = set()
    good: list[str] = []
    dup_lines = lines = failed = kept_chars = 0
    for line in text.split("\n"):
        words = _split(line)
        if not words:
            good.append(line)
            continue
        lines += 1
        all_words += words
        if line in seen:
            dup_lines += 1
        else:
            seen.add(line)
        if line_fails(line, words):
            failed += 1
        else:
            good.append(line)
            kept_chars += sum(map(len, words))
    n = len(all_words)
    chars = sum(map(len, all_words))
    symbols = sum(text.count(mark) for mark in SYMBOLS)
    repeats = repeated_words(all_words)
    base_failed = n < 10 or 100 * repeats > 20 * n
    share = kept_chars / chars if chars else 0.0
    return (
        doc_id, n, chars, symbols, dup_lines, repeats, base_failed,
        not base_failed and (share >= LEAST_KEPT or failed == 1 < lines), lines, failed, share, "\n".join(good),
    )


def _split(line: str) -> list[str]:
    # str.split() also splits at other white space, which belongs to words here.
    words = line.split()
    if line.isascii() and not any(mark in line for mark in "\x1c\x1d\x1e\x1f"):
        return words
    return [word for word in _SPLIT.split(line) if word]


_SPLIT = re.compile(f"[{WHITE}]+")


def clean_lines(documents: DataFrame) -> DataFrame:
    """Base counts, the verdict and the cleaned text of every document.

    ``cleaned`` has the lines that passed; it is empty for a null text.
    """
    return per_row(documents, ["doc_id", "text"], lambda: judge, SCHEMA)
