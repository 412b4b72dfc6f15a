"""Helpers that several operators of this folder share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from postwright.operators.shaping import BROADCAST_BYTES
from postwright.session import discard, stored, work_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared work folder and read it back.

    What follows starts from files that every executor can reach, so a lost
    executor costs at most the step that was running.
    """
    return stored(df, work_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}"))


def unstage(df: DataFrame) -> None:
    """Remove a staged table that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        discard(df.sparkSession, folder)


def small_side(df: DataFrame, width: int | Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a staged table for broadcast when its rows, of ``width`` bytes each, are small together.

    Beyond the limit the join is a shuffle join, in which adaptive execution
    splits hot keys.
    """
    width = F.lit(width) if isinstance(width, int) else width
    total = df.agg(F.sum(width.cast("double")).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(df) if total <= limit else df


def texts(column: pa.Array) -> list[str]:
    """Strings of a column; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def with_fields(df: DataFrame, names: list[str], ddl: str) -> T.StructType:
    """The fields of some columns of a table, and further ones written as DDL."""
    return T.StructType([df.schema[n] for n in names] + T.StructType.fromDDL(ddl).fields)


def map_rows(
    df: DataFrame, schema: T.StructType, make: Callable[[], Callable[[pa.RecordBatch], dict]]
) -> DataFrame:
    """Apply a function to the Arrow batches of a table.

    ``make`` runs once per task and returns the function from a batch to a
    dictionary of output columns.
    """
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            found = work(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    x if isinstance(x, pa.Array) else pa.array(x, type=f.type)
                    for f, x in ((f, found[f.name]) for f in target)
                ],
                schema=target,
            )

    return df.mapInArrow(run, schema)


class WordIds:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, bound: int = 400_000) -> None:
        self.known: dict[bytes, int] = {}
        self.bound = bound

    def __call__(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        if len(self.known) > self.bound:
            self.known.clear()
        known, digest = self.known, xxhash.xxh3_64_intdigest
        out = []
        for word in words:
            value = known.get(word)
            if value is None:
                value = known[word] = digest(word)
            out.append(value)
        return np.array(out, dtype=np.uint64)


class WordHashes(dict):
    """The same hashes of words; those of a bounded number of words are remembered."""

    def __init__(self, bound: int) -> None:
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.bound:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = values + _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def windows(ids: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash for each run of ``size`` words."""
    n = len(ids) - size + 1
    total = np.zeros(max(n, 0), dtype=np.uint64)
    if n > 0:
        for k in range(size):
            total = mixed(total ^ ids[k : k + n])
    return total


def words_of(text: str, lower: bool = False) -> list[bytes]:
    """Runs of characters other than the six white-space characters, as UTF-8.

    ``bytes.split`` without argument parts at exactly these six bytes.
    ``lower`` turns A-Z into a-z and leaves all other letters alone, which is
    what ``bytes.lower`` does.
    """
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()
