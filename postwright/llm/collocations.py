"""Phrases of two to four words that stand together, counted in a HAT-trie.

Texts are split into pieces at punctuation and line ends, and pieces into words; everything is
counted per language.  A phrase that occurs ``LEAST`` times is a candidate.  Its score is that
of its weakest cut into two parts, twice its count over the counts of both parts.

1. All runs of one to four words are hashed to counters, whose number follows that of the words.
   Tasks count a stretch of words at a time and hand their counters on packed; Spark sums them
   up segment by segment.  What a counter that stays below ``LEAST`` stands for cannot be a
   candidate or a part of one; the others are marked in bits.
2. The runs that are marked are counted exactly, in a trie of word ids, two levels deep at most,
   over hash containers; a container that grows beyond a bound bursts into one for each next
   word.  When the trie is full, its largest subtrees are handed on as sorted runs, whole, and
   Spark merges the runs of each prefix partition (the first two words).
3. Parts and longer phrases are joined to the candidates by phrase.

Cases: null and empty texts have no words; a null language is ``und``; repeated rows count
again; texts of any length are read whole; ties go to the smallest cut, and in the ranking to
the phrase that is smaller in UTF-8; an empty table gives an empty one; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from postwright.llm.common import WordHashes, mixed, small_side, stage

#: Most words of a phrase.
LONGEST = 4
#: Least occurrences of a candidate.
LEAST = 30
#: A candidate goes where a longer one around it has this share, in per cent, of its occurrences.
INSIDE = 80
#: Score of a phrase whose words occur nowhere else.
UNIT = 1_000_000
#: Phrases returned per language.
TOP = 2000
#: Language of rows without one.
UNKNOWN = "und"
#: Characters that end a piece.
ENDS = ".,;:!?\n\x0b\x0c\r"

#: Entries that a trie holds, and a container before it bursts.
ENTRIES = 600_000
BURST = 512
#: Counters of a segment, as a power of two.
SEGMENT = 20
#: Counters for each word of the texts, as a power of two, and at most and at least.  The marks
#: that every task holds take a bit for each; beyond 2^30 counters they get fuller instead.
COUNTERS_EACH = 2
MAX_COUNTERS = 30
MIN_COUNTERS = SEGMENT

#: Bits of a word id in a packed key.
_ID = 20
_MASK = (1 << _ID) - 1
_PIECES = bytes(0x0A if chr(x) in ENDS else x for x in range(256)).lower()

#: Stands between pieces; no byte of UTF-8.
STOP = b"\xff"
#: Bytes of one language that a task looks at together.
STRETCH = 3 << 20

#: A packed sorted run.
RUNS = "place int, lang string, n int, data binary"


def marked_text(text: str | None) -> bytes:
    """A text in UTF-8, A-Z lower-cased, with the word ``STOP`` wherever a piece ends, and at its end."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_PIECES)
    return raw.replace(b"\n", b" " + STOP + b" ") + b" " + STOP


def seed_of(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"), 1))


def run_hashes(words: np.ndarray, stops: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For one to LONGEST words: hashes of the runs that start at each word, and which are in a piece.

    ``words`` are hashes of the words of a language, ``stops`` where a piece ends.
    """
    hashes, whole = np.zeros(len(words), dtype=np.uint64), np.ones(len(words), dtype=bool)
    for size in range(LONGEST):
        n = len(words) - size
        if n < 1:
            return
        hashes = mixed(hashes[:n] ^ words[size:])
        whole = whole[:n] & ~stops[size:]
        yield hashes, whole


@dataclass(frozen=True)
class Stretch:
    """Words in order, as numbers of different words, the hashes of these, and where a piece ends."""

    different: list[bytes]
    at: np.ndarray
    hashes: np.ndarray
    stops: np.ndarray


class Stretches:
    """The texts of a task by language, looked at some at a time."""

    def __init__(self) -> None:
        self.hash_of = WordHashes(200_000)
        self.waiting: dict[str, list[bytes]] = {}
        self.sizes: Counter = Counter()

    def add(self, lang: str, text: bytes) -> bool:
        """Whether there are enough to be looked at."""
        self.waiting.setdefault(lang, []).append(text)
        self.sizes[lang] += len(text)
        return self.sizes[lang] >= STRETCH

    def take(self, lang: str) -> Stretch:
        del self.sizes[lang]
        # the bytes are not looked at as characters, so STOP may be among them
        texts = pa.array(self.waiting.pop(lang), pa.binary()).view(pa.string())
        words = pc.ascii_split_whitespace(texts).flatten().view(pa.binary())
        words = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
        different = words.dictionary.to_pylist()
        at = words.indices.to_numpy()
        is_stop = np.fromiter((w == STOP for w in different), dtype=bool, count=len(different))
        hashes = self.hash_of.of(different) ^ seed_of(lang)
        return Stretch(different, at, hashes, is_stop[at])


def _packed(counters: np.ndarray, power: int) -> Iterator[dict]:
    """The counters hit by a stretch, and how often, segment by segment."""
    at, times = np.unique(counters, return_counts=True)
    times = np.minimum(times, LEAST).astype(np.uint8)
    segment = at >> SEGMENT
    edges = np.r_[0, np.flatnonzero(np.diff(segment)) + 1, len(at)]
    low = at & np.uint32((1 << SEGMENT) - 1)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if a < b:
            steps = np.diff(low[a:b], prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T
            data = zlib.compress(steps.tobytes() + times[a:b].tobytes(), 1)
            yield {"segment": int(segment[a]), "n": b - a, "data": data}


def sketched(source: DataFrame, power: int) -> DataFrame:
    """Packed counters of all runs of one to LONGEST words, by segment."""
    schema = T.StructType.fromDDL("segment int, n int, data binary")
    target = to_arrow_schema(schema)

    def counted(stretches: Stretches, lang: str) -> Iterator[dict]:
        found = stretches.take(lang)
        shift = np.uint64(64 - power)
        hit = [
            (h[whole] >> shift).astype(np.uint32)
            for h, whole in run_hashes(found.hashes[found.at], found.stops)
        ]
        yield from _packed(np.concatenate(hit), power)

    def rows(batches):
        stretches = Stretches()
        for lang, text in _texts(batches):
            if stretches.add(lang, marked_text(text)):
                yield from counted(stretches, lang)
        for lang in list(stretches.waiting):
            yield from counted(stretches, lang)

    return source.mapInArrow(lambda batches: _arrow(rows(batches), target), schema)


def marked(sketch: DataFrame) -> DataFrame:
    """(segment, bits): the counters of each segment that reach LEAST."""
    schema = T.StructType.fromDDL("segment int, bits binary")
    target = to_arrow_schema(schema)

    def run(batches):
        open_segment, totals = None, np.zeros(1 << SEGMENT, dtype=np.uint8)

        def out():
            bits = np.packbits(totals >= LEAST, bitorder="little").tobytes()
            totals[:] = 0
            return pa.RecordBatch.from_pylist([{"segment": open_segment, "bits": bits}], target)

        for batch in batches:
            for segment, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment != open_segment:
                    if open_segment is not None:
                        yield out()
                    open_segment = segment
                raw = np.frombuffer(zlib.decompress(data), np.uint8)
                steps = np.ascontiguousarray(raw[: 4 * n].reshape(4, n).T).view(np.uint32).ravel()
                at = np.cumsum(steps, dtype=np.uint32)
                # each place once, and both sides at most LEAST
                totals[at] = np.minimum(totals[at] + raw[4 * n :], LEAST)
        if open_segment is not None:
            yield out()

    dealt = sketch.repartition("segment").sortWithinPartitions("segment")
    return dealt.mapInArrow(run, schema)


def marks(source: DataFrame, power: int) -> bytes:
    """A bit for each counter: whether it reaches LEAST; 2^MAX_COUNTERS bits at most."""
    width = 1 << SEGMENT - 3
    out = bytearray((1 << power) // 8)
    for row in stage(marked(sketched(source, power)), "marks").toLocalIterator():
        out[row["segment"] * width : (row["segment"] + 1) * width] = row["bits"]
    return bytes(out)


def counters_for(source: DataFrame) -> int:
    """The power of two of the counters' number: some for each word, which has six letters or so."""
    letters = source.agg(F.sum(F.length("text").cast("double")).alias("n")).first()["n"] or 0
    wanted = COUNTERS_EACH * letters / 6
    return min(MAX_COUNTERS, max(MIN_COUNTERS, math.ceil(math.log2(wanted + 1))))


class Inner(dict):
    """A node that has burst: containers by next word id."""


class Numbers(dict):
    """Ids of words, from 1, given as they come."""

    def __init__(self) -> None:
        super().__init__()
        self.words: list[bytes] = [b""]

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        return number


class HatTrie:
    """Counts of sequences of word ids, under a first word each.

    A node is a container, a plain dictionary from the packed rest of the
    sequence to its count, until it holds ``BURST`` rests; then it becomes an
    ``Inner`` node.  Ids start from 1; a rest of 0 ends the sequence.
    """

    def __init__(self, entries: int = ENTRIES) -> None:
        self.limit = entries
        self.clear()

    def clear(self) -> None:
        self.ids = Numbers()
        self.words = self.ids.words
        self.tops: dict[str, dict[int, dict]] = {}
        self.entries = 0

    def crowded(self) -> bool:
        return len(self.words) >= _MASK // 2

    def add(self, top: dict, first: int, rest: int, times: int = 1) -> None:
        node = top.get(first)
        if node is None:
            node = top[first] = {}
        if type(node) is Inner:
            second = rest & _MASK
            rest >>= _ID
            under = node.get(second)
            if under is None:
                under = node[second] = {}
            node = under
            first = 0
        n = node.get(rest)
        if n is not None:
            node[rest] = n + times
            return
        node[rest] = times
        self.entries += 1
        if first and len(node) > BURST:
            inner = top[first] = Inner()
            for key, count in node.items():
                inner.setdefault(key & _MASK, {})[key >> _ID] = count

    @staticmethod
    def _size(node: dict) -> int:
        return sum(map(len, node.values())) if type(node) is Inner else len(node)

    def _phrase(self, first: int, rest: int) -> bytes:
        words = [self.words[first]]
        while rest:
            words.append(self.words[rest & _MASK])
            rest >>= _ID
        return b" ".join(words)

    def run(self, lang: str, first: int) -> tuple[str, list[tuple[bytes, int]]]:
        """A subtree as a sorted run; it leaves the trie."""
        node = self.tops[lang].pop(first)
        self.entries -= self._size(node)
        rows = []
        if type(node) is Inner:
            for second, under in node.items():
                rows += [(self._phrase(first, rest << _ID | second), n) for rest, n in under.items()]
        else:
            start, words = self.words[first] + b" ", self.words
            rows += [
                (start + words[rest] if 0 < rest <= _MASK else self._phrase(first, rest), n)
                for rest, n in node.items()
            ]
        rows.sort()
        return lang, rows

    def spill(self, share: float = 0.5) -> Iterator[tuple[str, list[tuple[bytes, int]]]]:
        """The largest subtrees as sorted runs, until this share of the entries has left."""
        left = self.entries * (1 - share)
        subtrees = sorted(
            ((self._size(node), lang, first) for lang, top in self.tops.items()
             for first, node in top.items()),
            reverse=True,
        )
        for _, lang, first in subtrees:
            if self.entries <= left:
                break
            yield self.run(lang, first)


def _place(lang: str, phrase: bytes, places: int) -> int:
    """The prefix partition of a phrase: by its language and first two words."""
    prefix = b" ".join(phrase.split(b" ", 2)[:2])
    return xxhash.xxh3_64_intdigest(prefix, hash_seed(lang)) % places


def hash_seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"), 2)


def _dealt(runs: Iterator[tuple[str, list[tuple[bytes, int]]]], places: int) -> Iterator[dict]:
    """Sorted runs, one for each prefix partition and language, packed."""
    dealt: dict[tuple[int, str], list[tuple[bytes, int]]] = {}
    for lang, rows in runs:
        for row in rows:
            dealt.setdefault((_place(lang, row[0], places), lang), []).append(row)
    for (place, lang), rows in dealt.items():
        rows.sort()
        phrases, counts = zip(*rows, strict=True)
        data = np.array(counts, dtype=np.int64).tobytes() + b"\n".join(phrases)
        yield {"place": place, "lang": lang, "n": len(rows), "data": zlib.compress(data, 1)}


def _arrow(rows: Iterator[dict], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _texts(batches) -> Iterator[tuple[str, str | None]]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def counted_phrases(
    source: DataFrame, bits: bytes, power: int, entries: int = ENTRIES, places: int = 64
) -> DataFrame:
    """Sorted runs of the exact counts of all marked runs of words; those of an empty phrase count all."""
    known = source.sparkSession.sparkContext.broadcast(bits)
    schema = T.StructType.fromDDL(RUNS)
    target = to_arrow_schema(schema)

    def rows(batches):
        trie = HatTrie(entries)
        stretches = Stretches()
        shift, mark = np.uint64(64 - power), np.frombuffer(known.value, np.uint8)
        totals: Counter = Counter()

        def is_marked(hashes: np.ndarray) -> np.ndarray:
            at = (hashes >> shift).astype(np.int64)
            return (mark[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

        def count(lang: str) -> None:
            found = stretches.take(lang)
            totals[lang] += int((~found.stops).sum())
            top = trie.tops.setdefault(lang, {})
            hashes = found.hashes[found.at]
            (single, _), *_ = run_hashes(found.hashes, np.zeros(len(found.hashes), dtype=bool))
            ids = np.fromiter(
                (trie.ids[w] if good else 0
                 for w, good in zip(found.different, is_marked(single).tolist(), strict=True)),
                dtype=np.int64, count=len(single),
            )
            run = np.zeros(len(hashes) + LONGEST, dtype=np.int64)
            run[: len(hashes)] = np.where(found.stops, 0, ids[found.at])
            for size, (h, whole) in enumerate(run_hashes(hashes, found.stops), 1):
                start = np.flatnonzero(whole & is_marked(h))
                # a run with a word that is not marked does not occur often enough
                parts = [run[start + k] for k in range(size)]
                good = np.logical_and.reduce([x > 0 for x in parts])
                first, rest = parts[0][good], np.zeros(int(good.sum()), dtype=np.int64)
                for k in range(1, size):
                    rest |= parts[k][good] << _ID * (k - 1)
                if size < 4:
                    both, times = np.unique(first | rest << _ID, return_counts=True)
                    first, rest = both & _MASK, both >> _ID
                    each = zip(first.tolist(), rest.tolist(), times.tolist(), strict=True)
                    for a, b, n in each:
                        trie.add(top, a, b, n)
                else:
                    for a, b in zip(first.tolist(), rest.tolist(), strict=True):
                        trie.add(top, a, b)

        for lang, text in _texts(batches):
            if not stretches.add(lang, marked_text(text)):
                continue
            count(lang)
            if trie.entries >= trie.limit:
                yield from _dealt(trie.spill(), places)
            if trie.crowded():
                yield from _dealt(trie.spill(1.0), places)
                trie.clear()
        for lang in list(stretches.waiting):
            count(lang)
            if trie.crowded():
                yield from _dealt(trie.spill(1.0), places)
                trie.clear()
        yield from _dealt(trie.spill(1.0), places)
        yield from _dealt(((lang, [(b"", n)]) for lang, n in totals.items()), places)

    return source.mapInArrow(lambda batches: _arrow(rows(batches), target), schema)


def merged(runs: DataFrame) -> DataFrame:
    """The runs of each prefix partition merged: (lang, phrase, f) of what occurs often enough.

    The phrase is null where f counts all words.  A partition at a time is held,
    each of its phrases once.
    """
    schema = T.StructType.fromDDL("lang string, phrase string, f bigint")
    target = to_arrow_schema(schema)

    def rows(batches):
        place, counts = None, Counter()

        def out():
            for phrase, n in counts.items():
                if n >= LEAST or not phrase:
                    text = phrase.decode("utf-8", "surrogatepass") if phrase else None
                    yield {"lang": place[1], "phrase": text, "f": n}

        for batch in batches:
            for *at, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != place:
                    yield from out()
                    place, counts = at, Counter()
                raw = zlib.decompress(data)
                times = np.frombuffer(raw, np.int64, n).tolist()
                for phrase, k in zip(raw[8 * n :].split(b"\n"), times, strict=True):
                    counts[phrase] += k
        yield from out()

    dealt = runs.repartition("place").sortWithinPartitions("place", "lang")
    return dealt.mapInArrow(lambda batches: _arrow(rows(batches), target, 10_000), schema)


def frequent(
    documents: DataFrame, text: str = "text", lang: str = "lang", entries: int = ENTRIES,
    power: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of up to LONGEST words that occur LEAST times, staged; (lang, n).

    ``power`` is that of the number of counters.
    """
    source = documents.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col(text).cast("string").alias("text"),
    )
    power = power or counters_for(source)
    places = 8 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = counted_phrases(source, marks(source, power), power, entries, places)
    counted = stage(merged(runs), "phrases")
    totals = counted.filter("phrase is null").select("lang", F.col("f").alias("n"))
    return counted.filter("phrase is not null"), totals


def _exact(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words or more, by their weakest cut."""
    known = phrases.select("lang", "phrase", F.col("f"))
    candidates = phrases.withColumn("w", F.split("phrase", " ")).filter(F.size("w") > 1)
    part = lambda low, n: F.array_join(F.slice("w", low, n), " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "k",
        part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"),
    )
    side = lambda name, count: small_side(
        known.select("lang", F.col("phrase").alias(name), F.col("f").alias(count)),
        F.length(name) + 40,
    )
    both = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    score = F.expr(
        f"(CAST({2 * UNIT} AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0))) div "
        "(CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"
    )
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return both.groupBy("lang", "phrase").agg(F.first("a").alias("a"), weakest.alias("c")).select(
        "lang", "phrase", "a", "c.l", "c.r", "c.score"
    )


def inside_longer(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, around): the most occurrences of a longer candidate around a phrase."""
    words = phrases.withColumn("w", F.split("phrase", " ")).filter(F.size("w") > 2)
    parts = (
        "flatten(transform(sequence(2, size(w) - 1), n -> "
        "transform(sequence(1, size(w) - n + 1), i -> array_join(slice(w, i, n), ' '))))"
    )
    each = words.select("lang", "f", F.explode(F.expr(parts)).alias("phrase"))
    return each.groupBy("lang", "phrase").agg(F.max("f").alias("around"))


def mine(
    documents: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP,
    **limits,
) -> DataFrame:
    """The ``top`` phrases of each language: rank, phrase, its counts and score."""
    phrases, totals = frequent(documents, text, lang, **limits)
    around = small_side(inside_longer(phrases), F.length("phrase") + 40)
    kept = scored(phrases).join(around, ["lang", "phrase"], "left").filter(
        F.col("around").isNull()
        | (_exact(F.col("around")) * 100 < _exact(F.col("a")) * INSIDE)
    )
    order = Window.partitionBy("lang").orderBy(
        F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()
    )
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(small_side(totals, 64), "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
