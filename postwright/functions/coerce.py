"""Text to typed value, with failures as null instead of errors."""

from __future__ import annotations

from postwright import fixed
from postwright.functions.sql import cases, listed, quote

_ASCII_SPACE = r"[ \t\n\x0B\f\r]"
_NUMBER = rf"\A{_ASCII_SPACE}*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?{_ASCII_SPACE}*\z"
_INFINITY = r"(?i)\A[+-]?inf(inity)?\z"

_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_ZONE = r"(?i:z|utc|gmt|[+-]\d{2}:?\d{2})"
# layout of the text -> parse pattern; the zone is appended before parsing
_LAYOUTS = [
    (r"\A\d{8}\z", "yyyyMMdd"),
    (r"\A\d{1,2}/\d{1,2}/\d{4}\z", "M/d/yyyy"),
    (r"\A\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}\z", "M/d/yyyy H:mm"),
    (r"\A\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}\z", "M/d/yyyy H:mm:ss"),
    (r"\A\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2} [AP]M\z", "M/d/yyyy h:mm a"),
    (r"\A[A-Z][a-z]{2} \d{1,2}, \d{4}\z", "MMM d, yyyy"),
    (r"\A\d{1,2}-[A-Z][a-z]{2}-\d{4}\z", "d-MMM-yyyy"),
]


def strip(value: str) -> str:
    """White space of any kind removed from both ends."""
    return f"btrim({value}, {quote(fixed.SPACE_CHARACTERS)})"


def null_tokens(value: str) -> str:
    """Null for the texts that stand for a missing value, matched exactly."""
    return f"CASE WHEN {value} NOT IN ({listed(fixed.NULL_TOKENS)}) THEN {value} END"


def tri_state(value: str) -> str:
    """TRUE/FALSE in any case and padding; everything else is null."""
    return f"CASE upper({strip(value)}) WHEN 'TRUE' THEN TRUE WHEN 'FALSE' THEN FALSE END"


def to_number(value: str) -> str:
    """Double, or null where the text is not a plain decimal number or an infinity.

    Java-only spellings (``1d``, hex) are refused by the grammar, and a decimal
    too large for a double is null rather than infinite.
    """
    number = f"try_cast(btrim({value}, {quote(fixed.ASCII_SPACE_CHARACTERS)}) AS DOUBLE)"
    return cases(
        [
            (
                f"{value} RLIKE {quote(_NUMBER)}",
                f"CASE WHEN abs({number}) < double('inf') THEN {number} END",
            ),
            (f"{value} RLIKE {quote(_INFINITY)}", f"try_cast({value} AS DOUBLE)"),
        ]
    )


def to_utc_timestamp(value: str) -> str:
    """Timestamp of a stripped text, read as UTC unless it names an offset; else null.

    The zone is always part of the parsed text, so the result does not depend on
    the session time zone.
    """

    def like(pattern: str) -> str:
        return f"{value} RLIKE {quote(pattern)}"

    def cast(text: str) -> str:
        return f"try_cast({text} AS TIMESTAMP)"

    def swap(text: str, pattern: str, by: str) -> str:
        return f"regexp_replace({text}, {quote(pattern)}, {quote(by)})"

    # an offset needs its colon, a time its seconds
    zoned = swap(f"upper({value})", r"([+-]\d{2})(\d{2})\z", "$1:$2")
    zoned = swap(zoned, rf"([T ]\d{{1,2}}:\d{{2}})({_ZONE})\z", "$1:00$2")
    iso = [
        (like(rf"\A{_DAY}\z"), cast(f"concat({value}, 'T00:00:00Z')")),
        (like(rf"\A{_DAY}[T ].*{_ZONE}\z"), cast(zoned)),
        (like(rf"\A{_DAY}[T ]\d{{1,2}}:\d{{2}}\z"), cast(f"concat({value}, ':00Z')")),
        (like(rf"\A{_DAY}[T ]\d"), cast(f"concat({value}, 'Z')")),
        (like(r"\A\d{4}\z"), cast(f"concat({value}, '-01-01T00:00:00Z')")),
        (like(r"\A\d{4}-\d{1,2}\z"), cast(f"concat({value}, '-01T00:00:00Z')")),
    ]
    other = [
        (like(pattern), f"try_to_timestamp(concat({value}, ' +0000'), {quote(layout + ' Z')})")
        for pattern, layout in _LAYOUTS
    ]
    return cases(iso + other)


def yes_no(value: str) -> str:
    """True as Yes, False as No, null as null."""
    return f"CASE WHEN {value} THEN 'Yes' WHEN NOT {value} THEN 'No' END"
