"""Small helpers for SQL expression texts."""

from __future__ import annotations

from collections.abc import Iterable


def quote(text: str) -> str:
    """String literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(texts: Iterable[str]) -> str:
    return ", ".join(quote(t) for t in texts)


def ascii_only(value: str) -> str:
    return f"octet_length({value}) = length({value})"


def ahead(starts: str, pattern: str) -> str:
    """The same pattern, tried only where one of the characters follows that every match starts with.

    A look at one character is much cheaper than a word boundary or the branches of a pattern.
    """
    return f"(?=[{starts}])(?:{pattern})"


def any_of(conditions: Iterable[str]) -> str:
    return "(" + " OR ".join(conditions) + ")"


def has(value: str, literal: str) -> str:
    return f"contains({value}, {quote(literal)})"


def cases(branches: Iterable[tuple[str, str]], otherwise: str = "NULL") -> str:
    """The value of the first true condition."""
    whens = " ".join(f"WHEN {condition} THEN {value}" for condition, value in branches)
    return f"CASE {whens} ELSE {otherwise} END"


def let(value: str, name: str, body: str) -> str:
    """``body`` over a value computed once.

    An expression used inside a lambda is computed again for every element; a
    lambda variable is not.
    """
    return f"transform(array({value}), {name} -> {body})[0]"
