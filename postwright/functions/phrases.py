"""Tokens, window phrases and index terms as arrays."""

from __future__ import annotations

from collections.abc import Iterable

from postwright import fixed
from postwright.functions.sql import ascii_only, let, listed, quote


def skill_tokens(text: str) -> str:
    """Lower-cased tokens without stopwords and one-character pieces, in text order."""
    # in ASCII text the plain classes, which are faster, match the same
    pieces = (
        f"CASE WHEN {ascii_only(text)} THEN split(lower({text}), {quote(fixed.TOKEN_SEPARATOR)}) "
        f"ELSE split(lower({text}), {quote('(?U)' + fixed.TOKEN_SEPARATOR)}) END"
    )
    return (
        f"filter({pieces}, t -> length(t) >= {fixed.MIN_TOKEN_LENGTH} "
        f"AND t NOT IN ({listed(fixed.SKILL_STOPWORDS)}))"
    )


def _windows_of(words: str, size: int) -> str:
    """All runs of ``size`` neighbouring words, each joined by one blank."""
    if size == 1:
        return words
    # sequence(1, 0) counts down, so an array too short for the window needs the guard
    starts = (
        f"CASE WHEN size({words}) >= {size} THEN sequence(1, size({words}) - {size - 1}) "
        "ELSE array() END"
    )
    # single elements, because a slice reads the whole array each time: that would be quadratic
    parts = ", ' ', ".join(f"{words}[i + {k}]" for k in range(-1, size - 1))
    return f"transform({starts}, i -> concat({parts}))"


def windows(words: str, sizes: Iterable[int]) -> str:
    """Runs of every size in ``sizes`` as one array, duplicates kept."""
    parts = ", ".join(_windows_of("ws", n) for n in sorted(sizes))
    return let(words, "ws", f"concat({parts})")


def skill_phrases(
    tokens: str, sizes: Iterable[int] = range(1, fixed.MAX_PHRASE_TOKENS + 1)
) -> str:
    """Distinct window phrases of at least three characters."""
    long_enough = f"p -> length(p) >= {fixed.MIN_PHRASE_LENGTH}"
    return f"array_distinct(filter({windows(tokens, sizes)}, {long_enough}))"


def index_terms(text: str) -> str:
    """Word 1- to 3-grams for the similarity index, duplicates kept."""
    words = f"regexp_extract_all(lower({text}), {quote(fixed.INDEX_WORD)}, 0)"
    return windows(words, range(1, fixed.MAX_TERM_WORDS + 1))
