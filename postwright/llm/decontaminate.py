"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.
Every run of ``window`` consecutive words of an item is a pattern (an item with
fewer words is one pattern).  All patterns stand in one automaton, each text is
read through it once, and every occurrence is mapped back to the words, and so
to the characters, of the original text.

Cases: null and empty texts have no words and no hits; an item without words
has no pattern; items with equal texts all count, as do repeated rows of an
``item_id`` (once per id); an empty benchmark hits nothing.  A text is read
whole, whatever its length.  Further columns of the documents pass through.

The automaton is built from the items, not from the corpus.  Their total size
is measured first: items are dealt into slices of at most ``slice_bytes``, and
each slice has an automaton of its own, so that a task never holds more than
one slice in memory.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwright.llm.common import map_rows, with_fields

#: Words of a window.
WINDOW = 10
#: Bytes of benchmark text behind one automaton.
SLICE_BYTES = 4 << 20

_WORD_BYTES = bytes(
    x if 0x30 <= x <= 0x39 or 0x61 <= x <= 0x7A or x >= 0x80 else 0x20 for x in range(256)
)


def normal_words(text: str | None) -> list[bytes]:
    """The words of a text: one table turns every other ASCII character into a space."""
    if not text:
        return []
    return text.encode("utf-8", "surrogatepass").lower().translate(_WORD_BYTES).split(b" ")


def _kept(words: list[bytes]) -> list[bytes]:
    return [w for w in words if w]


def patterns(items: list[tuple[str, str | None]], window: int = WINDOW) -> dict[bytes, set[str]]:
    """The patterns of some items, each with the items it comes from."""
    found: dict[bytes, set[str]] = {}
    for item, text in items:
        words = _kept(normal_words(text))
        for k in range(max(1, len(words) - window + 1) if words else 0):
            found.setdefault(b" ".join(words[k : k + window]), set()).add(item)
    return found


class Scanner:
    """Finds the windows of a slice of items in texts."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for pattern, owners in patterns(items, window).items():
            # latin-1 gives one character per byte, so offsets are byte offsets
            text = f" {pattern.decode('latin-1')} "
            self.automaton.add_word(text, (len(text), tuple(sorted(owners))))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """(first word, word after the last, items) of each occurrence."""
        if self.empty or not words:
            return
        starts = None
        line = f" {b' '.join(words).decode('latin-1')} "
        for end, (length, owners) in self.automaton.iter(line):
            if starts is None:
                starts, at = [], 0
                for word in words:
                    starts.append(at)
                    at += len(word) + 1
            first = bisect_right(starts, end - length + 1) - 1
            after = bisect_right(starts, end - 1)
            yield first, after, owners


class Slices:
    """The items by slice; a worker process keeps the automaton of the slice it used last."""

    def __init__(self, items: list[list[tuple[str, str | None]]], window: int) -> None:
        self.items, self.window = items, window
        self.last: tuple[int, Scanner] | None = None

    def __iter__(self) -> Iterator[Scanner]:
        for k, items in enumerate(self.items):
            if self.last is None or self.last[0] != k:
                self.last = k, Scanner(items, self.window)
            yield self.last[1]


def _slices(benchmark: DataFrame, slice_bytes: int) -> list[DataFrame]:
    """The benchmark as one table per slice of bounded size."""
    total = benchmark.agg(F.sum(F.octet_length("text") + F.lit(64)).alias("b")).first()["b"] or 0
    n = max(1, -(-2 * total // slice_bytes)) if total > slice_bytes else 1
    if n == 1:
        return [benchmark]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [benchmark.filter(part == k) for k in range(n)]


def scan(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Per document: words, hit words, items with windows in it, and the hit spans.

    Returns key, n_words, n_hit, n_items, items_sha256, contaminated and
    ``spans``: (start, end) of each run of hit words as character offsets of the
    original text, end exclusive.  The order of rows is that of the documents.
    """
    slices = []
    for part in _slices(benchmark, slice_bytes):
        rows = part.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t"))
        slices.append([(r["i"], r["t"]) for r in rows.collect() if r["i"] is not None])
    schema = with_fields(
        documents, [key],
        "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
        "contaminated boolean, spans array<struct<start:bigint,end:bigint>>",
    )
    held = documents.sparkSession.sparkContext.broadcast(Slices(slices, window))

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            raw = batch.column(1).to_pylist()
            words = [_kept(normal_words(t)) for t in raw]
            hits: list[set[int]] = [set() for _ in raw]
            items: list[set[str]] = [set() for _ in raw]
            for scanner in held.value:
                for row, each in enumerate(words):
                    for first, after, owners in scanner.find(each):
                        hits[row].update(range(first, after))
                        items[row].update(owners)
            sha = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
            return {
                key: batch.column(0),
                "n_words": [len(x) for x in words],
                "n_hit": [len(x) for x in hits],
                "n_items": [len(x) for x in items],
                "items_sha256": sha,
                "contaminated": [bool(x) for x in hits],
                "spans": [original_spans(t, h) if h else [] for t, h in zip(raw, hits)],
            }

        return work

    return map_rows(documents.select(key, text), schema, make)


def original_spans(text: str, hit: set[int]) -> list[dict[str, int]]:
    """Character offsets of runs of hit words in the text as it came."""
    spans: list[list[int]] = []
    last = -2
    at = number = 0
    size = len(text)
    while at < size:
        c = text[at]
        if not (c >= "\x80" or c.isalnum()):
            at += 1
            continue
        start = at
        while at < size and (text[at] >= "\x80" or text[at].isalnum()):
            at += 1
        if number in hit:
            if number == last + 1:
                spans[-1][1] = at
            else:
                spans.append([start, at])
            last = number
        number += 1
    return [{"start": a, "end": b} for a, b in spans]


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without those in which a window of a test item occurs.

    Documents are matched with their verdict inside one pass: no join, so
    repeated ids and null ids keep their own verdict.
    """
    numbered = F.struct(*[F.col(c) for c in documents.columns]).alias("doc")
    scanned = scan(
        documents.select(numbered, F.col("text")), benchmark, key="doc", **options
    )
    return scanned.filter(~F.col("contaminated")).select("doc.*")
