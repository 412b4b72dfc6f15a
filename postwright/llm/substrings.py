"""Removal of passages that an earlier document holds, by Rabin-Karp hashes of all word windows.

Every run of ``WINDOW`` words of a text is a window.  The words of a window go when the
same words also start somewhere in a document of smaller id.

1. Each task hashes all windows of a stretch of documents (a rolling polynomial; a second
   polynomial names the bucket).  Of equal windows within the stretch those of the smallest
   id are posted; the others are found already.  So however many documents share a passage,
   a stretch posts it once.
2. Posts are packed per bucket and shuffled by it; the number of buckets follows that of the
   characters, so that a task can hold one.  There windows are sorted by hash and id, and those
   whose first one has a smaller id are found.
3. What was found goes back to its stretch, packed, where overlapping windows merge into
   maximal intervals of words.
4. Documents with intervals are joined to them, by id and hash of the text; the words
   outside are kept.

Two windows count as equal when both 64-bit polynomials say so, of the second one only the
bucket (the remainder by the number of buckets): some 70 bits.

Cases: null and empty texts have no words; texts of fewer words than a window keep them all;
documents of one id, or of one text and id, take nothing from each other, null ids count as
larger than all others; texts of any length are read whole; an empty table gives an empty
one.  Extra columns, whatever their names, stay with ``deduplicate`` and are left out by
``measure``.  Ids are integers.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postwright.llm.common import (
    WordHashes, map_rows, mixed, small_side, stage, with_fields, words_of,
)

#: Words of a window.
WINDOW = 50
#: Windows, and documents, that a task holds at a time.
STRETCH_WINDOWS = 1 << 19
STRETCH_DOCUMENTS = 60_000
#: Characters of text whose windows go to one bucket, at most on average.
BUCKET = 32 << 20
#: Texts taken from a batch at a time.
SLICE = 500
#: Windows found that a task holds before it hands them on.
HELD = 1 << 17

#: Odd factors of the two polynomials.
_FACTORS = (0x9E3779B97F4A7C13, 0xC2B2AE3D27D4EB4B)
_LAST = np.iinfo(np.int64).max

POSTS = "place int, bucket int, token bigint, n int, hashes binary, data binary"
FOUND = "token bigint, is_table boolean, data binary"


class RabinKarp:
    """Hashes of all runs of ``size`` words, modulo 2^64."""

    def __init__(self, factor: int, size: int = WINDOW) -> None:
        self.size = size
        self.factor = np.uint64(factor)
        self.inverse = np.uint64(pow(factor, -1, 1 << 64))
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers))
            steps = np.full(n, self.factor)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)
            steps[1:] = self.inverse
            self.inverses = np.multiply.accumulate(steps)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        count = len(ids) - self.size + 1
        if count < 1:
            return np.zeros(0, dtype=np.uint64)
        self._grow(len(ids))
        upto = np.zeros(len(ids) + 1, dtype=np.uint64)
        np.cumsum(ids * self.powers[: len(ids)], out=upto[1:])
        return mixed((upto[self.size :] - upto[:count]) * self.inverses[:count])


def pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers, byte plane by byte plane, compressed."""
    planes = [
        np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()
        for x in columns
    ]
    return zlib.compress(b"".join(planes), 1)


def unpack(data: bytes, *shapes: tuple[int, str]) -> list[np.ndarray]:
    """The columns of ``pack``, given their lengths and types."""
    raw, at, out = zlib.decompress(data), 0, []
    for n, kind in shapes:
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * width
    return out


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def intervals(starts: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Maximal [start, end) covered by windows at these sorted starts."""
    if not len(starts):
        return starts, starts
    apart = np.flatnonzero(np.diff(starts) > size)
    return starts[np.r_[0, apart + 1]], starts[np.r_[apart, len(starts) - 1]] + size


class Stretch:
    """Documents of one task whose windows are compared among themselves before any are posted."""

    def __init__(self, buckets: int, limit: int = STRETCH_WINDOWS) -> None:
        self.buckets, self.limit = buckets, limit
        self.hash, self.deal = (RabinKarp(f) for f in _FACTORS)
        self.ids = WordHashes(100_000)
        self.clear()

    def clear(self) -> None:
        self.docs: list[tuple] = []
        self.windows = 0

    def add(self, doc: int | None, text_hash: int, text: str) -> None:
        words = self.ids.of(words_of(text))
        hashes = self.hash(words)
        deals = (self.deal(words) % np.uint64(self.buckets)).astype(np.int32)
        if len(hashes):
            self.docs.append((_LAST if doc is None else doc, doc is None, text_hash, hashes, deals))
            self.windows += len(hashes)

    def full(self) -> bool:
        return self.windows >= self.limit or len(self.docs) >= STRETCH_DOCUMENTS

    def posts(self) -> Iterator[dict]:
        """The rows of this stretch: its table of documents, and its posts per bucket."""
        if not self.docs:
            return
        self.docs.sort(key=lambda d: (d[0], d[1], d[2]))
        n = len(self.docs)
        ids = np.array([d[0] for d in self.docs], dtype=np.int64)
        nulls = np.array([d[1] for d in self.docs], dtype=np.uint8)
        texts = np.array([d[2] for d in self.docs], dtype=np.int64)
        sizes = np.array([len(d[3]) for d in self.docs])
        hashes = np.concatenate([d[3] for d in self.docs])
        bucket = np.concatenate([d[4] for d in self.docs])
        doc = np.repeat(np.arange(n, dtype=np.uint16), sizes)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        token = xxhash.xxh3_64_intdigest(ids.tobytes() + nulls.tobytes() + texts.tobytes()) >> 1
        self.clear()

        order = np.argsort(hashes, kind="stable")  # equal windows by document
        h, b = hashes[order], bucket[order]
        first = np.r_[True, (h[1:] != h[:-1]) | (b[1:] != b[:-1])]
        leader = order[np.flatnonzero(first)][np.cumsum(first) - 1]
        later = np.zeros(len(doc), dtype=bool)
        later[order] = ids[doc[order]] > ids[doc[leader]]

        here = np.flatnonzero(later)
        table = pack(ids, nulls, texts)
        yield {
            "place": token % self.buckets, "bucket": None, "token": token, "n": None, "hashes": None,
            "data": _table(table, n, doc[here], at[here].astype(np.uint32)),
        }
        rest = np.flatnonzero(~later)
        kind = np.uint16 if self.buckets <= 1 << 16 else np.int32
        rest = rest[np.argsort(bucket[rest].astype(kind), kind="stable")]
        edges = np.r_[0, np.flatnonzero(np.diff(bucket[rest])) + 1, len(rest)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            if low == high:
                continue
            part = rest[low:high]
            known, counts = np.unique(doc[part], return_counts=True)
            yield {
                "place": int(bucket[part[0]]), "bucket": int(bucket[part[0]]), "token": token,
                "n": len(part), "hashes": hashes[part].tobytes(),
                "data": len(known).to_bytes(4, "little") + pack(
                    _steps(known), counts.astype(np.uint32), _steps(ids[known]),
                    _steps(at[part].astype(np.uint32)),
                ),
            }


def _table(table: bytes, n: int, doc: np.ndarray, at: np.ndarray) -> bytes:
    head = n.to_bytes(4, "little") + len(table).to_bytes(4, "little")
    return head + table + _hits(doc, at)


def _hits(doc: np.ndarray, at: np.ndarray) -> bytes:
    return len(doc).to_bytes(4, "little") + pack(_steps(doc), _steps(at))


def _read_hits(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    doc, at = unpack(data[4:], (n, "u2"), (n, "u4"))
    return np.cumsum(doc, dtype=np.uint16), np.cumsum(at, dtype=np.uint32)


def _arrow(rows: Iterable[dict], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _fields(ddl: str) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType.fromDDL(ddl)
    return schema, to_arrow_schema(schema)


def posted(source: DataFrame, buckets: int, limit: int = STRETCH_WINDOWS) -> DataFrame:
    """The posts of a table of (id, hash of the text, text)."""
    schema, target = _fields(POSTS)

    def rows(batches):
        stretch = Stretch(buckets, limit)
        for doc, text_hash, text in (
            row for batch in batches for k in range(0, batch.num_rows, SLICE)
            for row in zip(*(c.to_pylist() for c in batch.slice(k, SLICE).columns), strict=True)
        ):
            if text:
                stretch.add(doc, text_hash, text)
            if stretch.full():
                yield from stretch.posts()
        yield from stretch.posts()

    return source.mapInArrow(lambda batches: _arrow(rows(batches), target), schema)


def _unpacked(row: dict) -> tuple[np.ndarray, ...]:
    """Hash, document, stretch and place in it, of each posted window of a row."""
    n, data = row["n"], row["data"]
    known = int.from_bytes(data[:4], "little")
    doc, counts, ids, at = unpack(
        data[4:], (known, "u2"), (known, "u4"), (known, "i8"), (n, "u4")
    )
    place = np.repeat(np.cumsum(doc, dtype=np.uint16).astype(np.int64) << 40, counts)
    return (
        np.frombuffer(row["hashes"], np.uint64), np.repeat(np.cumsum(ids), counts),
        np.full(n, row["token"]), place | np.cumsum(at, dtype=np.uint32).astype(np.int64),
    )


def _later(bucket: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """Stretch and place of the windows of a bucket that a document of smaller id has too."""
    hashes, doc, token, at = (np.concatenate(x) for x in zip(*bucket, strict=True))
    order = np.lexsort((doc, hashes))
    hashes, doc = hashes[order], doc[order]
    new = np.r_[True, hashes[1:] != hashes[:-1]]
    later = doc > doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    return token[order[later]], at[order[later]]


def matched(posts: DataFrame) -> DataFrame:
    """The windows with a smaller id before them, packed per stretch; tables pass through.

    A task holds one bucket at a time.
    """
    schema, target = _fields(FOUND)

    def hits(held: list[tuple]) -> Iterator[dict]:
        token, at = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((at, token))
        token, at = token[order], at[order]
        edges = np.r_[0, np.flatnonzero(np.diff(token)) + 1, len(token)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            if low < high:
                doc = (at[low:high] >> 40).astype(np.uint16)
                start = (at[low:high] & ((1 << 40) - 1)).astype(np.uint32)
                yield {"token": int(token[low]), "is_table": False, "data": _hits(doc, start)}

    def rows(batches):
        held, n, place, bucket = [], 0, None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["n"] is None:
                    yield {"token": row["token"], "is_table": True, "data": row["data"]}
                    continue
                if row["bucket"] != place:
                    if bucket:
                        held.append(_later(bucket))
                        n += len(held[-1][0])
                    place, bucket = row["bucket"], []
                    if n >= HELD:
                        yield from hits(held)
                        held, n = [], 0
                bucket.append(_unpacked(row))
        if bucket:
            held.append(_later(bucket))
        if held:
            yield from hits(held)

    dealt = posts.repartition("place").sortWithinPartitions("place")
    return dealt.mapInArrow(lambda batches: _arrow(rows(batches), target), schema)


def merged(found: DataFrame, key: str, kind: T.DataType) -> DataFrame:
    """(key, _hash, starts, ends) of the documents that lose words, from what was found per stretch.

    A group is one stretch: its table, and at most one hit for each of its windows.
    """
    schema = T.StructType([T.StructField(key, kind)] + T.StructType.fromDDL(
        "_hash bigint, starts array<bigint>, ends array<bigint>"
    ).fields)

    def run(group: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        ids = nulls = texts = None
        docs, starts = [], []
        for is_table, data in zip(
            group["is_table"].to_pylist(), group["data"].to_pylist(), strict=True
        ):
            if is_table:
                n, size = (int.from_bytes(data[k : k + 4], "little") for k in (0, 4))
                ids, nulls, texts = unpack(data[8 : 8 + size], (n, "i8"), (n, "u1"), (n, "i8"))
                data = data[8 + size :]
            doc, at = _read_hits(data)
            docs.append(doc)
            starts.append(at)
        doc, at = np.concatenate(docs), np.concatenate(starts).astype(np.int64)
        order = np.lexsort((at, doc))
        doc, at = doc[order], at[order]
        edges = np.r_[0, np.flatnonzero(np.diff(doc.astype(np.int64))) + 1, len(doc)]
        rows = []
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            if low < high:
                d = doc[low]
                first, end = intervals(at[low:high])
                rows.append({
                    key: None if nulls[d] else int(ids[d]), "_hash": int(texts[d]),
                    "starts": first.tolist(), "ends": end.tolist(),
                })
        return pa.Table.from_pylist(rows, to_arrow_schema(schema))

    grouped = found.groupBy("token").applyInArrow(run, schema)
    # stretches of the same documents come to the same intervals
    return grouped.dropDuplicates([key, "_hash"])


def removals(
    documents: DataFrame, key: str = "doc_id", text: str = "text", limit: int = STRETCH_WINDOWS
) -> DataFrame:
    """(key, _hash, starts, ends): intervals of words to remove; only documents that have some; staged.

    ``limit`` is the number of windows that a task compares among themselves.
    """
    source = documents.select(
        F.col(key).cast("bigint"), F.xxhash64(text), F.col(text).cast("string").alias("text")
    )
    size = source.agg(F.sum(F.length("text").cast("double")).alias("n")).first()["n"] or 0
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(8 * parts, math.ceil(size / BUCKET))
    found = matched(posted(source, buckets, limit))
    return stage(merged(found, key, documents.schema[key].dataType), "removals")


def _marked(documents: DataFrame, key: str, text: str, keep: list, **limits) -> DataFrame:
    """The columns ``keep``, ``_text`` and the intervals, of every document."""
    gone = removals(documents, key, text, **limits).withColumnsRenamed({key: "_r_key", "_hash": "_r_hash"})
    gone = small_side(gone, 64 + 16 * F.size("starts"))
    source = documents.select(
        *keep, F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"),
        F.col(text).cast("string").alias("_text"),
    )
    same = F.col("_key").eqNullSafe(F.col("_r_key")) & (F.col("_hash") == F.col("_r_hash"))
    return source.join(gone, same, "left").drop("_key", "_hash", "_r_key", "_r_hash")


def kept_words(text: str | None, starts: list[int] | None, ends: list[int] | None) -> tuple[int, list[bytes]]:
    """The number of words of a text, and the words outside the intervals."""
    words = words_of(text) if text else []
    if not starts:
        return len(words), words
    kept, at = [], 0
    for start, end in zip(starts, ends, strict=True):
        kept += words[at:start]
        at = end
    return len(words), kept + words[at:]


def measure(
    documents: DataFrame, key: str = "doc_id", text: str = "text", **limits
) -> DataFrame:
    """Per document: words, words removed, hash of the rest, and the intervals removed."""
    marked = _marked(documents, key, text, [key], **limits)
    schema = with_fields(
        documents, [key],
        "n_words bigint, n_removed bigint, kept_sha256 string, "
        "removed array<struct<start:bigint,end:bigint>>",
    )

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            words, removed, digests, spans = [], [], [], []
            for value, starts, ends in zip(
                *(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True
            ):
                n, kept = kept_words(value, starts, ends)
                words.append(n)
                removed.append(n - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                spans.append([
                    {"start": s, "end": e} for s, e in zip(starts or [], ends or [], strict=True)
                ])
            return {
                key: batch.column(0), "n_words": words, "n_removed": removed,
                "kept_sha256": digests, "removed": spans,
            }

        return work

    return map_rows(marked, schema, make)


def deduplicate(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents as they came, except that texts that lose words are their kept words, joined by blanks."""
    names, schema = documents.columns, documents.schema
    marked = _marked(documents, key, text, [F.struct(*names).alias("_doc")])

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            docs = batch.column(0)
            out = {n: docs.field(i) for i, n in enumerate(names)}
            out[text] = pa.array([
                b" ".join(kept_words(t, s, e)[1]).decode("utf-8", "surrogatepass") if s else t
                for t, s, e in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True)
            ], type=pa.string())
            return out

        return work

    return map_rows(marked, schema, make)
