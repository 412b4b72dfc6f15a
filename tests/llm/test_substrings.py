"""Removal of repeated passages against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from postwright.llm import substrings

N = substrings.WINDOW


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows):
    """Per row of (id, text): words, words removed, hash of the rest."""
    least = {}
    order = lambda d: (d is None, d or 0)
    for doc, text in rows:
        w = words_of(text)
        for k in range(len(w) - N + 1):
            p = tuple(w[k : k + N])
            if p not in least or order(doc) < least[p]:
                least[p] = order(doc)
    out = []
    for doc, text in rows:
        w = words_of(text)
        gone = set()
        for k in range(len(w) - N + 1):
            if least[tuple(w[k : k + N])] < order(doc):
                gone.update(range(k, k + N))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, parts=3, **limits):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    got = substrings.measure(df, **limits).drop("removed").collect()
    return sorted((tuple(r) for r in got), key=str)


def passages(seed, documents=60):
    """Texts that share passages around the window's length, some within themselves."""
    rng = random.Random(seed)
    shared = [[f"s{k}w{i}" for i in range(n)] for k, n in enumerate((49, 50, 51, 75, 130, 400))]
    rows = []
    for doc in range(documents):
        words = []
        for _ in range(rng.randrange(4)):
            words += [f"d{doc}x{rng.randrange(1000)}" for _ in range(rng.randrange(60))]
            passage = rng.choice(shared)
            low = rng.randrange(3)
            words += passage[low : len(passage) - rng.randrange(3)]
        rows.append((doc, rng.choice([" ", "\n", " \t "]).join(words)))
    return rows


@pytest.mark.parametrize("seed,limit", [(1, 1 << 20), (2, 200), (3, 1)])
def test_against_brute_force(spark, seed, limit):
    rows = passages(seed)
    rng = random.Random(seed)
    rng.shuffle(rows)
    assert found(spark, rows, limit=limit) == brute(rows)


def test_self_overlap_and_periodic_texts(spark):
    rows = [
        (1, "a " * 300), (2, "a " * 70), (3, "a " * 49), (4, "a b " * 60), (5, "b a " * 60),
        (6, "a " * 49 + "c " + "a " * 60),
    ]
    assert found(spark, rows) == brute(rows)


def test_nulls_repeated_ids_and_ties(spark):
    text = " ".join(f"w{k}" for k in range(120))
    other = " ".join(f"w{k}" for k in range(60, 200))
    rows = [
        (5, text), (5, text), (5, other), (None, text), (None, other), (7, None), (8, ""),
        (9, " \n\t"), (-3, other), (2**62, text),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, limit=1) == brute(rows)


def test_very_long_text(spark):
    long = " ".join(f"v{k}" for k in range(150_000))
    rows = [(1, long), (2, "x " + long + " y"), (3, " ".join(f"v{k}" for k in range(70_000, 70_080)))]
    assert found(spark, rows) == brute(rows)


def test_many_copies_are_posted_once_per_stretch(spark):
    text = " ".join(f"w{k}" for k in range(80))
    df = spark.createDataFrame([(k, text) for k in range(500)], "doc_id bigint, text string")
    source = df.coalesce(1).select("doc_id", F.xxhash64("text"), "text")
    posts = substrings.posted(source, 8).filter("bucket is not null")
    assert posts.agg(F.sum("n")).first()[0] == 31
    got = {r["doc_id"]: r["n_removed"] for r in substrings.measure(df).collect()}
    assert got == {k: 80 if k else 0 for k in range(500)}


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id bigint, text string, _hash string, token string, starts string, removed string"
    empty = spark.createDataFrame([], schema)
    assert substrings.measure(empty).collect() == []
    text = " ".join(f"w{k}" for k in range(60))
    df = spark.createDataFrame(
        [(1, text + " own", "h", "t", "s", "r"), (2, text + "  two", None, "t", "s", "r")], schema
    )
    assert [r["n_removed"] for r in substrings.measure(df).orderBy("doc_id").collect()] == [0, 60]
    kept = {r["doc_id"]: r for r in substrings.deduplicate(df).collect()}
    assert kept[1]["text"] == text + " own" and kept[2]["text"] == "two"
    assert substrings.deduplicate(df).columns == df.columns and kept[2]["token"] == "t"
    assert kept[2]["_hash"] is None


def test_rolling_hash_is_that_of_each_window():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 2**63, 400).astype(np.uint64)
    ids[100:160] = ids[200:260]
    for factor in substrings._FACTORS:
        got = substrings.RabinKarp(factor)(ids)
        plain = [substrings.RabinKarp(factor)(ids[k : k + N])[0] for k in range(len(ids) - N + 1)]
        assert got.tolist() == plain and len(set(plain)) == len(plain) - 11


def test_packed_columns_come_back():
    a, b = np.array([3, 1, 2**63 - 1], dtype=np.int64), np.array([7, 9], dtype=np.uint16)
    x, y = substrings.unpack(substrings.pack(a, b), (3, "i8"), (2, "u2"))
    assert x.tolist() == a.tolist() and y.tolist() == b.tolist()
