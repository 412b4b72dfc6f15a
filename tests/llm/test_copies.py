"""Near-duplicates in a group of looser copies: components, and pairs that are looked at."""

import random

from postwright.llm import minhash

WORDS = 150


def copies(number, seed=5):
    """Copies of one text, each with a few words changed, a fifth of them in places of a copy before."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(WORDS)]
    found, places = [], []
    for n in range(number):
        where = rng.sample(range(WORDS), rng.randint(3, 5))
        if places and rng.random() < 0.2:
            where = rng.choice(places)
        places.append(where)
        text = list(base)
        for k in where:
            text[k] = f"x{n}y{k}"
        found.append((n, " ".join(text)))
    return found


def brute_components(rows):
    sets = []
    for _, text in rows:
        words = text.split()
        sets.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)})
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {rows[k][0]: rows[top(k)][0] for k in range(len(rows))}


def test_looser_copies_are_not_all_paired(spark, monkeypatch):
    counts, whole = [], minhash.agreeing

    def counted(pairs, posted):
        counts.append(pairs.count())
        return whole(pairs, posted)

    monkeypatch.setattr(minhash, "agreeing", counted)
    rows = copies(260)
    found = {
        r["doc_id"]: r["component_id"]
        for r in minhash.components_of(spark.createDataFrame(rows, "doc_id bigint, text string"))
        .collect()
    }
    assert found == brute_components(rows)
    assert len(set(found.values())) > 20  # many stay alone, none may be lost
    assert len(counts) == 3 and counts[-1] < len(rows) ** 2 // 20


def test_offsets_find_every_link(spark):
    """Pairs of the members around any hub: all links between components, and few others."""
    rows = copies(120, seed=9)
    texts = spark.createDataFrame(rows, "node bigint, text string")
    ids = minhash.WordIds()
    sets = {n: minhash.shingles(t, ids) for n, t in rows}
    for hub in (0, 1, 2):
        pairs = spark.createDataFrame([(hub, n) for n, _ in rows if n != hub], "hub bigint, node bigint")
        around = minhash.offsets(pairs, texts)
        near = {r["node"] for r in around.filter("near").collect()} | {hub}
        assert near == {n for n in sets if minhash.linked(sets[hub], sets[n])}
        placed = spark.createDataFrame([(n, hub) for n in near], "node bigint, component bigint")
        met = {(r["a"], r["b"]) for r in minhash.offset_pairs(around, placed).collect()}
        part = {n: (hub if n in near else n) for n in sets}
        # of nodes with the same tokens in a component one stands for all
        joined = {frozenset((part[a], part[b])) for a, b in met}
        for a in sets:
            for b in sets:
                if a < b and part[a] != part[b] and minhash.linked(sets[a], sets[b]):
                    assert frozenset((part[a], part[b])) in joined
