"""Spelling variants grouped under their commonest near word, by permuterm rotations.

Words are runs of letters, counted over all documents.  Two words are near when one
inserted, deleted or replaced code point turns one into the other.

1. Runs are counted per task, and summed; words are numbered in code-point order.
2. Each word, ended by a mark, is turned into its rotations.  Around an edited place the word
   ``a c b`` becomes ``b mark a`` followed by ``c``: all words that differ there have rotations
   of one prefix, and the word without ``c`` has that prefix itself as a rotation.  A prefix is
   held as a hash of 127 bits, rolled from one rotation to the next, so that a word of m letters
   takes 2 m + 1 short rows, however long it is.
3. The rotations are sorted by prefix and letter; a scan of each prefix tells its words how many
   near words they have there and which of them is the commonest.  A prefix has at most one
   word for each letter and one that is whole in it.  A pair that differs by a replacement meets
   once.  One that differs by an indel meets once for each letter of the run of equal letters
   in which it lies; only the first of the run counts.
4. What the prefixes say is summed up per word; forms are followed to their root by doubling
   steps.

Cases: null and empty texts have no runs; a null id is written as ``null`` where the run's
deletion is decided; repeated rows count again; ties between near words go to the smaller one in
code-point order; texts of any length are read whole; an empty table gives an empty one; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from postwright.llm.common import small_side, stage

#: A run of letters.
RUN = "[A-Za-zÀ-ÿ]+"
#: Words have at least so many code points and occurrences.
MIN_LENGTH = 5
MIN_COUNT = 3
#: A run loses a letter where this divides the checksum of its document and itself.
EVERY = 97
#: A form occurs at least so many times as often as its word.
RATIO = 2
#: Words that a task counts before it hands them on.
HELD = 500_000

_RUN = re.compile(RUN)
# a rolling hash modulo a Mersenne prime; the mark is no letter
_PRIME = (1 << 127) - 1
_BASE = 0x1D8E4E27C47D124F9E3779B97F4A7C15
_MARK = 36
_POWERS = [1]


def words_in(doc: int | None, text: str | None) -> Counter:
    """The long enough words of a text, and how often each occurs."""
    found: Counter = Counter()
    if not text:
        return found
    lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    start = zlib.crc32(f"{'null' if doc is None else doc}:".encode())
    for run, n in Counter(_RUN.findall(lower)).items():
        if len(run) < MIN_LENGTH:
            continue
        check = zlib.crc32(run.encode(), start)
        if check % EVERY == 0:
            at = check % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < MIN_LENGTH:
                continue
        found[run] += n
    return found


def counted(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n, id) of the words with enough occurrences, ids in the order of the words; staged."""
    schema = T.StructType.fromDDL("word string, n bigint")
    target = to_arrow_schema(schema)

    def parts(held: Counter) -> Iterator[pa.RecordBatch]:
        words = pa.array(held.keys(), pa.string())
        counts = pa.array(held.values(), pa.int64())
        for k in range(0, len(words), 10_000):
            yield pa.RecordBatch.from_arrays(
                [words.slice(k, 10_000), counts.slice(k, 10_000)], schema=target
            )

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for word, n in words_in(doc, value).items():
                    held[word] += n
                if len(held) >= HELD:
                    yield from parts(held)
                    held = Counter()
        yield from parts(held)

    source = documents.select(key, F.col(text).cast("string"))
    words = source.mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))
    # numbers follow the order of a sorted table; they are fixed by storing it
    in_order = words.filter(F.col("n") >= MIN_COUNT).orderBy("word")
    return stage(in_order.withColumn("id", F.monotonically_increasing_id()), "words")


def rotations_of(word: str) -> Iterator[tuple[int, int, bool]]:
    """(prefix, letter, first): the word around each of its letters, and whole around each gap.

    The letter is 0 where the word is whole in its prefix; ``first`` says that the
    letter does not repeat the one before it.
    """
    codes = [ord(c) for c in word]
    m = len(codes)
    upto = [0]
    for c in codes:
        upto.append((upto[-1] * _BASE + c) % _PRIME)
    while len(_POWERS) < m + 2:
        _POWERS.append(_POWERS[-1] * _BASE % _PRIME)
    total = upto[m]
    for i in range(m + 1):
        # what follows the gap, the mark, what stands before the gap
        ended = _MARK * _POWERS[i] + upto[i]
        yield ((total - upto[i] * _POWERS[m - i]) * _POWERS[i + 1] + ended) % _PRIME, 0, True
        if i < m:
            after = total - upto[i + 1] * _POWERS[m - i - 1]
            first = i == 0 or codes[i] != codes[i - 1]
            yield (after * _POWERS[i + 1] + ended) % _PRIME, codes[i], first


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, letter, first, id, n) of all rotations."""
    schema = T.StructType.fromDDL(
        "prefix binary, letter int, first boolean, id bigint, n bigint"
    )
    target = to_arrow_schema(schema)

    def rows(batches):
        for batch in batches:
            for number, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for prefix, letter, first in rotations_of(word):
                    yield prefix.to_bytes(16, "big"), letter, first, number, n

    return words.select("id", "word", "n").mapInArrow(
        lambda batches: _batches(rows(batches), target), schema
    )


def neighbours_in(members: list[tuple[int, bool, int, int]]) -> Iterator[tuple]:
    """(id, near words, count of the commonest of them, its id) for the words of one prefix.

    Members are (letter, first, id, n).  All that have a letter are near each
    other; the whole word is near those whose letter is the first of its run.
    """
    ranked = sorted((-n, number, letter == 0, first) for letter, first, number, n in members)
    for _, number, whole, first in ranked:
        near = [
            (m, other) for m, other, is_whole, is_first in ranked
            if other != number and (is_first if whole else first if is_whole else True)
        ]
        if near:
            yield number, len(near), -near[0][0], near[0][1]


def scanned(ordered: DataFrame) -> DataFrame:
    """What each prefix of the sorted rotations says of its words: (id, n_near, near_n, near)."""
    schema = T.StructType.fromDDL("id bigint, n_near bigint, near_n bigint, near bigint")
    target = to_arrow_schema(schema)

    def rows(batches):
        open_prefix, members = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            prefixes = batch.column(0)
            codes = prefixes.dictionary_encode().indices.to_numpy()
            edges = np.r_[0, np.flatnonzero(codes[1:] != codes[:-1]) + 1, len(codes)]
            sizes = np.diff(edges)
            # a prefix of one word has nothing to say, unless it goes on in the next batch
            wanted = sizes > 1
            wanted[[0, -1]] = True
            for g in np.flatnonzero(wanted).tolist():
                low = int(edges[g])
                prefix = prefixes[low].as_py()
                part = batch.slice(low, int(sizes[g]))
                found = list(zip(*(part.column(k).to_pylist() for k in range(1, 5)), strict=True))
                if prefix == open_prefix:
                    members += found
                    continue
                if len(members) > 1:
                    yield from neighbours_in(members)
                open_prefix, members = prefix, found
        if len(members) > 1:
            yield from neighbours_in(members)

    return ordered.mapInArrow(lambda batches: _batches(rows(batches), target), schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= 10_000:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, near_n, near) of the words that have near words."""
    ordered = rotations(words).repartition("prefix").sortWithinPartitions("prefix", "letter")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))
    return scanned(ordered).groupBy("id").agg(
        F.sum("n_near").alias("n_near"), best.alias("b")
    ).select("id", "n_near", (-F.col("b.m")).alias("near_n"), F.col("b.w").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) from (id, form); staged.

    Each round follows all that is known so far, so the steps double; counts at
    least double along a chain, which bounds its length.
    """
    found = stage(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        hop = found.select(F.col("id").alias("root"), F.col("root").alias("next"))
        step = stage(found.join(small_side(hop, 32), "root", "left"), "roots")
        found = step.select("id", F.coalesce("next", "root").alias("root"))
        if not step.filter("next is not null").limit(1).count():
            return found


def group(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per word: its form and root, its count, the number of near words and its form's count."""
    words = counted(documents, key, text)
    enough = F.col("near_n") >= RATIO * F.col("n")
    placed = stage(
        words.join(neighbours(words), "id", "left").select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("near")).alias("form"),
            F.when(enough, F.col("near_n")).alias("form_n"),
        ),
        "placed",
    )
    ends = roots(placed.filter("form is not null").select("id", "form"))
    named = lambda name: small_side(
        words.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word")),
        F.length(f"{name}_word") + 40,
    )
    return (
        placed.join(small_side(ends, 32), "id", "left")
        .join(named("form"), "form", "left").join(named("root"), "root", "left")
        .select(
            "word", F.col("form_word").alias("form"),
            F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n",
        )
    )
