"""Quality rules on lines: frequent lines go, and documents that consist of them.

Per document the plain rules are counted (words, symbols, repeated lines,
repeated five-word windows).  Across documents, lines are normalised (A-Z
lower-cased, runs of digits as one 0, other runs of ASCII characters as one
space) and hashed, and per host the documents that hold a line are counted.
Copies of a document, with the same normalised lines from first to last, are
one document, and a line that a document repeats counts once.  A line is
frequent when at least
``min_documents`` documents of its host hold it, however many the host has.  A
document is depleted when less than ``min_left`` of its words stand outside
frequent lines.

Cases: null and empty texts have no words and fail the plain rules; a null host
is a host of its own; texts of any length are read whole; repeated rows are
documents of their own, and copies as said; an empty table gives an empty one.
Extra columns, whatever their names, stay with ``filter_documents`` and are
left out by ``measure``.

One staged table holds the counts and line hashes of each document, so text is
read once; what is shuffled is hashes.  Counts per line are summed before the
exchange, so a line or host that a third of all documents share is one row per
task there.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postwright.llm.common import (
    WordIds, map_rows, small_side, stage, windows, with_fields, words_of,
)

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: A document with fewer words fails.
MIN_WORDS = 10
#: Highest share, in per cent, of words in repeated windows.
MAX_REPEATED = 20
#: Words of a window.
WINDOW = 5
#: A frequent line stands in this many documents of its host at least.
MIN_DOCUMENTS = 10
#: Share of words that must stand outside frequent lines.
MIN_LEFT = 0.3

_SYMBOLS = re.compile(f"[{re.escape(SYMBOLS)}]")
_ZEROS = re.compile(rb"00+")
_NORMAL = bytes(
    x if 0x61 <= x <= 0x7A or x >= 0x80 else 0x30 if 0x30 <= x <= 0x39 else 0x20
    for x in range(256)
)

MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint"
)
LINES = "_copy bigint, lines array<struct<line:bigint,words:bigint>>"


def normal_line(line: str) -> bytes:
    """A line without letter case, punctuation and numbers, as UTF-8."""
    raw = line.encode("utf-8", "surrogatepass").lower().translate(_NORMAL)
    normal = b" ".join(raw.split())
    return _ZEROS.sub(b"0", normal) if b"00" in normal else normal


def repeated_words(ids: np.ndarray, size: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, the first occurrence included."""
    hashes = windows(ids, size)
    if len(hashes) < 2:
        return 0
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(hashes), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _signed(value: int) -> int:
    return struct.unpack("<q", struct.pack("<Q", value))[0]


def line_hashes(lines: list[str]) -> tuple[int, list[dict[str, int]]]:
    """Hash of a text's normalised lines together; hash of each that is not empty, and its words."""
    normal = [(x, len(words_of(line))) for line in lines if (x := normal_line(line))]
    whole = xxhash.xxh3_64_intdigest(b"\n".join(x for x, _ in normal))
    return _signed(whole), [
        {"line": _signed(xxhash.xxh3_64_intdigest(x)), "words": n} for x, n in normal
    ]


def counts(text: str | None, ids: WordIds) -> tuple[int, int, int, int, int]:
    """The plain measures of a text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = words_of(text)
    joined = b"".join(words)
    # a code point is a byte that does not continue one
    chars = len(joined.decode("utf-8", "surrogatepass"))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (
        len(words), chars, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)),
        repeated_words(ids(words)) if len(words) > WINDOW else 0,
    )


def _measured(documents: DataFrame, text: str, keep: list[str]) -> DataFrame:
    schema = with_fields(documents, keep, f"{MEASURES}, {LINES}")
    at = len(keep)

    def make():
        ids = WordIds()

        def work(batch: pa.RecordBatch) -> dict:
            raw = batch.column(at).to_pylist()
            found = list(zip(*(counts(t, ids) for t in raw), strict=True)) or [()] * 5
            out = {name: batch.column(i) for i, name in enumerate(keep)}
            names = [f.name for f in schema.fields[at:-2]]
            out |= {name: list(x) for name, x in zip(names, found, strict=True)}
            hashed = [line_hashes((t or "").split("\n")) for t in raw]
            out["_copy"] = [x for x, _ in hashed]
            out["lines"] = [x for _, x in hashed]
            return out

        return work

    source = documents.select(*keep, F.col(text).alias("_text"))
    return map_rows(source, schema, make)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )


def frequent_lines(lined: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Frequent lines per host, from a table of (host, _copy, lines)."""
    each = lined.select("host", "_copy", F.explode("lines.line").alias("line"))
    return (
        each.distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("holders"))
        .filter(F.col("holders") >= min_documents)
    )


def _judged(staged: DataFrame, **limits) -> tuple[DataFrame, DataFrame]:
    """The staged documents with their verdicts, and the frequent lines each row holds."""
    # a null host hashes to a value of its own, so that joins have plain keys
    lined = staged.select("_row", F.xxhash64("_host").alias("host"), "_copy", "lines")
    found = stage(frequent_lines(lined.select("host", "_copy", "lines"), **limits), "frequent")
    each = lined.select("_row", "host", F.explode("lines").alias("l")).select(
        "_row", "host", "l.line", "l.words"
    )
    hits = each.join(small_side(found, 32).drop("holders"), ["host", "line"])
    removed = hits.groupBy("_row").agg(
        F.sum("words").alias("_gone"), F.collect_set("line").alias("_lines")
    )
    return staged.drop("_copy", "lines"), removed


def measure(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_left: float = MIN_LEFT,
    **limits,
) -> DataFrame:
    """Per document: the plain measures, base_failed, words in frequent lines, and kept."""
    source = documents.select(key, F.col(host).alias("_host"), F.col(text).alias("_text"))
    staged = stage(
        _measured(source, "_text", [key, "_host"])
        .withColumn("_row", F.monotonically_increasing_id()),
        "measured",
    )
    plain, removed = _judged(staged, **limits)
    joined = plain.join(removed.select("_row", "_gone"), "_row", "left")
    gone = F.coalesce("_gone", F.lit(0))
    return joined.select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & (F.col("n_words") - gone >= min_left * F.col("n_words"))).alias("kept"),
        gone.alias("n_frequent_words"),
    )


def filter_documents(
    documents: DataFrame,
    text: str = "text",
    host: str = "source",
    min_left: float = MIN_LEFT,
    **limits,
) -> DataFrame:
    """The documents that pass, frequent lines taken out of their text, columns as they came."""
    whole = F.struct(*documents.columns).alias("_doc")
    staged = stage(
        _measured(
            documents.select(whole, F.col(host).alias("_host"), F.col(text).alias("_text")),
            "_text", ["_doc", "_host"],
        )
        .filter(~base_failed())
        .withColumn("_row", F.monotonically_increasing_id()),
        "measured",
    )
    plain, removed = _judged(staged, **limits)
    joined = plain.join(removed, "_row", "left")
    gone = F.coalesce("_gone", F.lit(0))
    kept = joined.filter(F.col("n_words") - gone >= min_left * F.col("n_words"))
    names = documents.columns
    schema = documents.schema

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            docs = batch.column(0)
            out = {n: docs.field(i) for i, n in enumerate(names)}
            frequent = batch.column(1).to_pylist()
            new = [
                without_lines(t, set(f)) if f else t
                for t, f in zip(out[text].to_pylist(), frequent, strict=True)
            ]
            out[text] = pa.array(new, type=pa.string())
            return out

        return work

    clean = map_rows(kept.select("_doc", "_lines"), schema, make)
    if "n_chars" in names:
        clean = clean.withColumn("n_chars", F.length(text).cast(schema["n_chars"].dataType))
    return clean.select(names)


def without_lines(text: str, frequent: set[int]) -> str:
    """A text without the lines whose normalised form is frequent."""
    out = []
    for line in text.split("\n"):
        normal = normal_line(line)
        if not normal or _signed(xxhash.xxh3_64_intdigest(normal)) not in frequent:
            out.append(line)
    return "\n".join(out)
