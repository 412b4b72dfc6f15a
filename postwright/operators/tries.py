"""Dictionary entries found in token arrays by a trie, all rows of a batch at once.

The trie is a few sorted arrays: entry tokens by number, and a node for each prefix of an entry,
found by its parent and the next token.  A scan starts at every token that begins an entry and
goes on only where an entry does, so its cost follows the tokens and the matches, not the
lengths that entries may have.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


@dataclass(frozen=True)
class Trie:
    """``keys`` are parent node * tokens + token, sorted; node k + 1 is that of key k, 0 the root."""

    tokens: pa.Array
    keys: np.ndarray
    entry: np.ndarray  # per node, the entry that ends there, or -1
    entries: pa.Array

    @staticmethod
    def of(entries: Iterable[str]) -> Trie:
        entries = sorted(set(entries))
        split = [e.split(" ") for e in entries]
        tokens = {t: k for k, t in enumerate(sorted({t for words in split for t in words}))}
        # prefixes in the order of their keys, level by level, so that a parent has its number first
        level = {(): 0}
        longer = [(k, tuple(tokens[t] for t in words)) for k, words in enumerate(split)]
        keys: list[int] = []
        ends: dict[int, int] = {}
        depth = 0
        while longer:
            depth += 1
            found = sorted({
                (level[w[: depth - 1]], w[depth - 1], w[:depth]) for _, w in longer
            })
            following = {}
            for parent, token, prefix in found:
                following[prefix] = len(keys) + 1
                keys.append(parent * len(tokens) + token)
            ends |= {following[w]: k for k, w in longer if len(w) == depth}
            longer = [(k, w) for k, w in longer if len(w) > depth]
            level = following
        entry = np.full(len(keys) + 1, -1, dtype=np.int64)
        entry[list(ends)] = list(ends.values())
        return Trie(
            pa.array(list(tokens), pa.string()), np.array(keys, dtype=np.int64), entry,
            pa.array(entries, pa.string()),
        )

    def scan(self, rows: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """(row, entry) of each entry in each row, once per row."""
        if not len(self.keys):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        words = rows.flatten()
        number = pc.index_in(words, value_set=self.tokens).fill_null(-1).to_numpy()
        sizes = pc.fill_null(pc.list_value_length(rows), 0).to_numpy().astype(np.int64)
        end = np.repeat(np.cumsum(sizes), sizes)
        row = np.repeat(np.arange(len(sizes)), sizes)
        at = np.flatnonzero(number >= 0)
        node = np.zeros(len(at), dtype=np.int64)
        depth, found_row, found_entry = 0, [], []
        while len(at):
            key = node * len(self.tokens) + number[at + depth]
            k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[k] == key
            at, node = at[known], k[known] + 1
            entry = self.entry[node]
            ends = entry >= 0
            found_row.append(row[at[ends]])
            found_entry.append(entry[ends])
            depth += 1
            inside = at + depth < end[at]
            at, node = at[inside], node[inside]
            goes_on = number[at + depth] >= 0
            at, node = at[goes_on], node[goes_on]
        if not found_row:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        both = np.concatenate(found_row) * len(self.entries) + np.concatenate(found_entry)
        both = np.unique(both)
        return both // len(self.entries), both % len(self.entries)


def scan_tokens(
    df: DataFrame, tokens: str, entries: Sequence[str], keep: Sequence[str], name: str
) -> DataFrame:
    """One row per row of ``df`` and entry found in its array ``tokens``; ``keep`` columns travel along.

    The entries are held by every task, so their size must have been checked.
    """
    known = df.sparkSession.sparkContext.broadcast(Trie.of(entries))
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(name, T.StringType())])
    target = to_arrow_schema(schema)

    def run(batches):
        trie = known.value
        for batch in batches:
            row, entry = trie.scan(batch.column(len(keep)))
            if len(row):
                taken = [batch.column(k).take(pa.array(row)) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*taken, trie.entries.take(pa.array(entry))], schema=target
                )

    return df.select(*keep, F.col(tokens)).mapInArrow(run, schema)
