"""Spelling variants against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from postwright.llm import spelling


def words_of(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode()) & 0xFFFFFFFF
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(rows):
    words = words_of(rows)
    close = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2):
        if near(a, b):
            close[a].append(b)
            close[b].append(a)
    form = {}
    for w, around in close.items():
        best = min(around, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(close[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def found(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    return sorted((tuple(r) for r in spelling.group(df).collect()), key=str)


def variants(seed, letters="abé", size=200):
    """Words over few letters, so that many are near and many letters repeat."""
    rng = random.Random(seed)
    words = ["".join(rng.choices(letters, k=rng.randrange(5, 7))) for _ in range(size)]
    rows = []
    for doc in range(120):
        ranks = [min(int(rng.expovariate(1 / 40)), size - 1) for _ in range(rng.randrange(60))]
        text = [words[k] for k in ranks]
        rows.append((doc, " ".join(w.upper() if rng.random() < 0.2 else w for w in text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rows = variants(seed)
    expected = brute(rows)
    assert any(r[1] for r in expected) and any(r[1] and r[1] != r[2] for r in expected), seed
    assert found(spark, rows) == expected


def test_repeated_letters_count_once(spark):
    rows = [(1, "aaaaa " * 10 + "aaaaaa " * 5 + "aaaaaaa " * 3 + "aabaaa " * 3)]
    assert found(spark, rows) == brute(rows)


def test_long_chain_has_one_root(spark):
    rows, word = [], "abcde"
    for k in range(9):
        rows.append((k, f"{word} " * (3 * 2 ** (9 - k))))
        word += "z"
    got = {w: (form, root) for w, form, root, *_ in found(spark, rows)}
    assert {root for _, root in got.values()} == {"abcde"} and len(got) == 9
    assert found(spark, rows) == brute(rows)


def test_nulls_ties_long_texts_and_repeated_rows(spark):
    long = "hello " * 30_000 + "hellx hellx hellx jello jello jello"
    rows = [
        (None, "house " * 4), (None, "houße " * 4), (1, None), (2, ""), (3, "mouse " * 20),
        (3, "mouse " * 20), (4, "louse " * 40), (5, long), (6, "a,b;c 12345 中文"),
        (7, "x" * 50_000 + " " + "x" * 50_000 + " " + "x" * 50_000),
    ]
    assert found(spark, rows) == brute(rows)


def test_groups_cross_batches(spark):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "3")
    try:
        rows = variants(9)
        assert found(spark, rows, 2) == brute(rows)
    finally:
        spark.conf.set(setting, before)


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id bigint, text string, word string, n string, key string, root string"
    assert spelling.group(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(1, "horse " * 6 + "hrose horsx " * 3, "w", "n", "k", "r")], schema)
    got = {r["word"]: r["form"] for r in spelling.group(df).collect()}
    assert got == {"horse": None, "hrose": None, "horsx": "horse"}


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in spelling.group(df).collect()), key=str)
    assert got == brute(rows)
