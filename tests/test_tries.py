"""Entries found by a trie against all windows."""

import random

import pyarrow as pa
import pytest

from postwright.operators.tries import Trie


@pytest.mark.parametrize("seed", range(40))
def test_trie_finds_what_windows_find(seed):
    rng = random.Random(seed)
    words = [f"t{k}" for k in range(rng.randrange(2, 6))]
    entries = {" ".join(rng.choices(words, k=rng.randrange(1, 6))) for _ in range(rng.randrange(15))}
    rows = [
        None if rng.random() < 0.1 else rng.choices([*words, "other"], k=rng.randrange(12))
        for _ in range(20)
    ]
    # a slice, as a batch's arrays may be one
    row, entry = Trie.of(entries).scan(pa.array([["t0"], *rows], pa.list_(pa.string())).slice(1))
    named = sorted(entries)
    got = [(int(r), named[int(e)]) for r, e in zip(row, entry, strict=True)]
    expected = {
        (k, " ".join(w[a:b])) for k, w in enumerate(rows) if w
        for a in range(len(w)) for b in range(a + 1, len(w) + 1) if " ".join(w[a:b]) in entries
    }
    assert len(got) == len(set(got)) and set(got) == expected


def test_scan_follows_matches_not_the_longest_entry():
    long = " ".join(f"w{k}" for k in range(500))
    trie = Trie.of([long, "w0 w1", "x"])
    row, entry = trie.scan(pa.array([["w0", "w1", "x"], long.split(" ")]))
    assert sorted(zip(row.tolist(), entry.tolist(), strict=True)) == [(0, 0), (0, 2), (1, 0), (1, 1)]
    assert len(trie.keys) == 501
