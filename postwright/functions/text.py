"""Description cleaning: decode, strip markup, mask contacts, tidy layout.

Almost all of it is JVM-side regular expressions.  Two steps have no Spark
built-in (the full HTML5 entity table and NFKC), so one Arrow UDF handles them,
and only for the rows that need it: every other row sends a null to Python.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwright import fixed
from postwright.functions.coerce import strip
from postwright.functions.sql import ahead, any_of, ascii_only, has, listed, quote

# Entities decoded on the JVM.  None decodes to a letter, digit, '#' or ';', so a
# decoded character cannot complete another entity; '&amp;' is decoded last so
# that nothing is decoded twice.
_COMMON_ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
    ("&nbsp;", "\u00a0"), ("&#160;", "\u00a0"), ("&copy;", "©"), ("&middot;", "·"),
    ("&bull;", "•"), ("&ndash;", "–"), ("&mdash;", "—"),
    ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
    ("&hellip;", "\u2026"), ("&amp;", "&"),
]
# An ampersand that might start an entity outside the list above.
_OTHER_ENTITY = (
    "&(?!(?:" + "|".join(e[1:-1] for e, _ in _COMMON_ENTITIES) + r");|[\t\n\f <&;]|\z)"
)
# Any character beyond those that NFKC leaves alone and that never combine with a
# neighbour, plus the two (no-break space, ellipsis) whose mapping is applied below.
_NFKC_OTHER = (
    r"[^\x00-\x7f\u00a0\u00a9\u00ae\u00b7\u00c0-\u00ff"
    r"\u2010\u2013\u2014\u2018-\u201e\u2020-\u2022\u2026]"
)


def _decoder():
    # Nested on purpose: workers receive the function by value and need not have
    # this package installed.
    tag, entity = fixed.HTML_TAG, fixed.HTML_ENTITY

    def decode(texts):
        import html
        import re
        import unicodedata

        import pyarrow as pa

        drop_tags, drop_entities = re.compile(tag), re.compile(entity)

        def one(text):
            if text is None:
                return None
            text = drop_tags.sub(" ", html.unescape(text))
            return unicodedata.normalize("NFKC", drop_entities.sub(" ", text))

        return pa.array([one(text) for text in texts.to_pylist()], pa.string())

    decode.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(decode, "string")


# Every step below names its argument several times, so it must be given a plain
# column, not an expression; ``chain`` sees to that.


def chain(df: DataFrame, source: str, steps: Sequence[Callable], into: str) -> DataFrame:
    """Apply steps one after the other, each in a projection of its own."""
    others = [c for c in df.columns if c != into]
    for step in steps:
        df = df.select(*others, F.expr(step(source)).alias(into))
        source = into
    return df


def _where(text: str, needed: str, changed: str) -> str:
    """Run an expensive change only on rows that can need it."""
    return f"CASE WHEN {needed} THEN {changed} ELSE {text} END"


def _swap(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {quote(pattern)}, {quote(by)})"


def _swap_unicode(text: str, flags: str, pattern: str, by: str) -> str:
    """A change by a pattern with Unicode classes and cases; in ASCII text the plain ones, which are faster, match the same."""
    plain = f"(?{flags})" if flags else ""
    return (
        f"CASE WHEN {ascii_only(text)} THEN {_swap(text, plain + pattern, by)} "
        f"ELSE {_swap(text, f'(?{flags}U)' + pattern, by)} END"
    )


def _beyond_ascii(text: str) -> str:
    return f"octet_length({text}) <> length({text})"


def strip_tags(text: str) -> str:
    """Tags of up to 200 characters become one blank."""
    return _where(text, has(text, "<"), _swap(text, fixed.HTML_TAG, " "))


def strip_entities(text: str) -> str:
    """Leftover entities become one blank."""
    return _where(text, has(text, "&"), _swap(text, fixed.HTML_ENTITY, " "))


def _decode_common(text: str) -> str:
    # a search for an entity is much cheaper than a replacement that finds none
    pairs = "map_entries(map({}))".format(listed(t for pair in _COMMON_ENTITIES for t in pair))
    one = "CASE WHEN contains(t, e.key) THEN replace(t, e.key, e.value) ELSE t END"
    every = f"aggregate({pairs}, {text}, (t, e) -> {one})"
    # most texts have no other entity than this, which is decoded last
    some = f"CASE WHEN {text} RLIKE '&(?!amp;)' THEN {every} ELSE replace({text}, '&amp;', '&') END"
    return _where(text, has(text, "&"), some)


def _normalise_common(text: str) -> str:
    plain = f"replace(replace({text}, '\u00a0', ' '), '\u2026', '...')"
    return _where(text, _beyond_ascii(text), plain)


def _rare(text: str) -> str:
    """The text where decoding or normalising needs more than the common cases."""
    return (
        f"CASE WHEN ({has(text, '&')} AND {text} RLIKE {quote(_OTHER_ENTITY)}) "
        f"OR ({_beyond_ascii(text)} AND {text} RLIKE {quote(_NFKC_OTHER)}) THEN {text} END"
    )


def mask_urls(text: str) -> str:
    needed = f"({has(text, '://')} OR {has(f'lower({text})', 'www.')})"
    return _where(text, needed, _swap_unicode(text, "i", ahead("hw", fixed.URL), " <URL> "))


def mask_phones(text: str) -> str:
    return _swap_unicode(text, "", ahead(r"(\d", fixed.PHONE), " <PHONE> ")


def mask_emails(text: str) -> str:
    return _where(text, has(text, "@"), _swap(text, fixed.EMAIL, " <EMAIL> "))


def break_bullets(text: str) -> str:
    """A bullet at a line start becomes a newline."""
    # (?d): only \n ends a line, so ^ does not match after a lone \r
    needed = any_of([f"NOT {ascii_only(text)}", *(has(text, b) for b in "*+-")])
    return _where(text, needed, _swap_unicode(text, "dm", fixed.BULLET, "\n"))


def collapse_blanks(text: str) -> str:
    """Runs of blanks and tabs become one blank; a single blank is left as it is."""
    needed = any_of(has(text, blank) for blank in ("  ", "\t", "\r", "\f", "\x0b"))
    return _where(text, needed, _swap(text, fixed.HORIZONTAL_SPACE_TO_CHANGE, " "))


def collapse_newlines(text: str) -> str:
    return _where(text, has(text, "\n\n\n"), _swap(text, fixed.NEWLINE_RUN, "\n\n"))


def strip_ends(text: str) -> str:
    """``strip``, which lists all characters of a text, only where one of its ends is white space."""
    blank = f"contains({quote(fixed.SPACE_CHARACTERS)}, substring({text}, {{}}, 1))"
    return _where(text, any_of([blank.format(1), blank.format(-1)]), strip(text))


STRIP_MARKUP = (strip_tags, strip_entities)
MASK_CONTACTS = (mask_urls, mask_phones, mask_emails)
TIDY_LAYOUT = (break_bullets, collapse_blanks, collapse_newlines, strip_ends)


def clean_description(
    df: DataFrame, column: str, into: str, max_length: int | None = None
) -> DataFrame:
    """Add the cleaned plain text of a column, never null.

    The whole text is read, or its first ``max_length`` code points where that is given.
    """
    others = [c for c in df.columns if c != into]
    raw = f"coalesce({column}, '')"
    if max_length is not None:
        raw = f"substring({raw}, 1, {max_length})"
    cut = df.select(*others, F.expr(raw).alias(into))
    found = cut.withColumn("_rare", F.expr(_rare(into)))
    native = chain(found, into, (_decode_common, *STRIP_MARKUP, _normalise_common), into)
    whole = native.select(*others, F.coalesce(_decoder()("_rare"), into).alias(into))
    return chain(whole, into, MASK_CONTACTS + TIDY_LAYOUT, into)
