"""Phrase mining against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from postwright.llm import collocations
from postwright.llm.common import WordIds


def brute(rows, top=collocations.TOP):
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            own = counts.setdefault(lang, Counter())
            for s in range(1, 5):
                own.update(tuple(w[k : k + s]) for k in range(len(w) - s + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= 30}
        inside = Counter()
        for p, a in candidates.items():
            for s in range(2, len(p)):
                for k in range(len(p) - s + 1):
                    inside[p[k : k + s]] = max(inside[p[k : k + s]], a)
        ranked = []
        for p, a in candidates.items():
            if p in inside and 100 * inside[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            text = " ".join(p)
            ranked.append((-score, -a, text.encode(), text, a, f[p[:k]], f[p[k:]], score))
        for rank, (*_, text, a, x, y, score) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, text, a, x, y, n[lang], score))
    return sorted(out)


def found(spark, rows, parts=3, **limits):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    return sorted(tuple(r) for r in collocations.mine(df, **limits).collect())


def phrases(seed, size=8, documents=80):
    """Texts over few words, so that phrases of all sizes repeat."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(size)] + ["Été", "ÀB", "x'y"]
    fixed = [["of", "the", "north", "sea"], ["New", "York"], ["a", "b", "a", "b", "a"]]
    rows = []
    for _ in range(documents):
        parts = []
        for _ in range(rng.randrange(30)):
            parts += rng.choice([fixed[rng.randrange(3)], rng.choices(words, k=rng.randrange(1, 4))])
            if rng.random() < 0.2:
                parts.append(rng.choice([",", ".", "\n", "\r\n", "\t", " !"]))
        rows.append((rng.choice(["en", "de", None, "und"]), " ".join(parts)))
    return rows


@pytest.mark.parametrize("seed,entries", [(1, 600_000), (2, 40), (3, 7)])
def test_against_brute_force(spark, seed, entries):
    rows = phrases(seed)
    expected = brute(rows)
    assert {len(r[2].split()) for r in expected} == {2, 3, 4}
    assert found(spark, rows, entries=entries) == expected


def test_top_and_ties(spark):
    rows = [("en", " . ".join(["p q", "r s", "t u", "p q r s"] * 30))]
    assert found(spark, rows, top=2) == brute(rows, 2)
    assert found(spark, rows) == brute(rows)


def test_long_pieces_nulls_and_empty_texts(spark):
    rows = [
        ("en", "la " * 40_000), (None, None), ("en", ""), ("de", " \t . , "), (None, "ja nein " * 40),
        ("en", "la la land " * 50), ("", "leer " * 64), ("en", "la la land " * 50),
    ]
    assert found(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    schema = "lang string, text string, phrase string, n string, f string, prefix string, k string"
    assert collocations.mine(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([("en", "big apple. " * 35, "p", "n", "f", "x", "k")], schema)
    assert [tuple(r) for r in collocations.mine(df).collect()] == [
        ("en", 1, "big apple", 35, 35, 35, 70, 1_000_000)
    ]


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["lang"], r["text"]) for r in df.select("lang", "text").collect()]
    assert sorted(tuple(r) for r in collocations.mine(df).collect()) == brute(rows)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    rows = [("en", "a", big), ("en", "b", big - 2), ("en", "a b", big - 7), ("en", "b c", 40), ("en", "c", 50)]
    df = spark.createDataFrame(rows, "lang string, phrase string, f bigint")
    got = {r["phrase"]: r["score"] for r in collocations.scored(df).collect()}
    assert got == {
        "a b": 2_000_000 * (big - 7) // (2 * big - 2), "b c": 2_000_000 * 40 // (big - 2 + 50),
    }


def test_trie_counts_whatever_bursts_and_spills():
    rng = random.Random(4)
    expected, got = Counter(), Counter()
    trie = collocations.HatTrie(200)
    for k in range(90_000):
        key = tuple(rng.choices(range(30), k=rng.randrange(1, 5)))
        expected[key] += 1
        first, *others = (trie.ids[b"%d" % w] for w in key)
        rest = 0
        for word in reversed(others):
            rest = rest << collocations._ID | word
        trie.add(trie.tops.setdefault("x", {}), first, rest)
        if k in (20_000, 50_000):
            for _, run in trie.spill():
                assert run == sorted(run) and len({p.split(b" ")[0] for p, _ in run}) == 1
                got.update({tuple(map(int, p.split(b" "))): n for p, n in run})
    assert any(type(node) is collocations.Inner for node in trie.tops["x"].values())
    for _, run in trie.spill(1.0):
        got.update({tuple(map(int, p.split(b" "))): n for p, n in run})
    assert got == expected and trie.entries == 0


def test_marks_hold_back_nothing_that_counts(spark):
    rows = phrases(6, documents=200)
    source = spark.createDataFrame(rows, "lang string, text string").fillna("und").repartition(3)
    phrase_counts = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").encode().lower().decode()):
            w = re.findall(r"[^\x20\x09]+", piece)
            for s in range(1, 5):
                phrase_counts.update(
                    ("und" if lang is None else lang, *w[k : k + s]) for k in range(len(w) - s + 1)
                )
    bits = collocations.marks(source, 20)
    ids, rare, let_through = WordIds(), 0, 0
    for (lang, *words), n in phrase_counts.items():
        hashes = ids([w.encode() for w in words]) ^ collocations.seed_of(lang)
        *_, (h, whole) = collocations.run_hashes(hashes, np.zeros(len(words), dtype=bool))
        at = int(h[0]) >> 64 - 20
        marked = bits[at >> 3] >> (at & 7) & 1
        assert whole[0] and (marked or n < 30)
        rare += n < 5
        let_through += bool(marked and n < 5)
    assert let_through < rare / 4


def test_few_counters_change_nothing(spark):
    rows = phrases(7)
    assert found(spark, rows, power=20) == brute(rows)
