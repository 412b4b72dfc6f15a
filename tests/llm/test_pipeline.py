"""The pipeline against a brute-force version in plain Python, on the smallest tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import corpus_pipeline
from postwright.llm import line_rules, mixing, secrets
from test_methods import FOLDER, base_by_hand, groups

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def normal(line):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)
    return re.sub("[0-9]+", "0", re.sub(r"[\x00-/:-`{-\x7f]+", " ", low)).strip(" ")


def frequent_lines(docs):
    held = defaultdict(set)
    for d in docs:
        lines = tuple(x for x in map(normal, (d["text"] or "").split("\n")) if x)
        for line in lines:
            held[d["source"], line].add(lines)  # copies have the same lines
    return {key for key, found in held.items() if len(found) >= line_rules.MIN_DOCUMENTS}


def by_rules(docs):
    measured = []
    for d in docs:
        words = WORDS.findall(d["text"] or "")
        seen = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        twice = {
            i for k in range(len(words) - 4) if seen[tuple(words[k : k + 5])] > 1
            for i in range(k, k + 5)
        }
        if len(words) >= 10 and 100 * len(twice) <= 20 * len(words):
            measured.append((d, len(words)))
    frequent = frequent_lines([d for d, _ in measured])
    out = []
    for d, n in measured:
        lines = d["text"].split("\n")
        gone = [x for x in lines if (d["source"], normal(x)) in frequent]
        if n - sum(len(WORDS.findall(x)) for x in gone) >= line_rules.MIN_LEFT * n:
            out.append(d | {"text": "\n".join(x for x in lines if x not in gone)})
    return out


def one_of_each(docs):
    found = groups({d["doc_id"]: d["text"] for d in docs})
    return [d for d in docs if found[d["doc_id"]][2]]


def without_items(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    windows = set()
    for text in items:
        words = word.findall(low(text))
        for k in range(max(1, len(words) - 9) if words else 0):
            windows.add(f" {' '.join(words[k : k + 10])} ")
    return [
        d for d in docs
        if not any(w in f" {' '.join(word.findall(low(d['text'])))} " for w in windows)
    ]


def mixture(docs):
    counted = [(d["doc_id"], d["source"], len(WORDS.findall(d["text"]))) for d in docs]
    own = Counter()
    for _, source, n in counted:
        own[source] += n
    total = sum(own.values())
    share = {s: n / total for s, n in own.items() if n}

    def weights(a):
        z = sum(p**a for p in share.values())
        return {s: p**a / z for s, p in share.items()}

    def bisect(holds):
        low, high = 0.0, 1.0
        if holds(1.0):
            return 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if holds(mid) else (low, mid)
        return low

    entropy = lambda a: -sum(w * math.log(w) for w in weights(a).values())
    most = lambda a: max(w / share[s] for s, w in weights(a).items())
    a = max(
        bisect(lambda x: entropy(x) >= mixing.TARGET_ENTROPY * math.log(len(share))),
        0.0 if most(0.0) <= mixing.MAX_EPOCHS else bisect(lambda x: most(x) > mixing.MAX_EPOCHS),
    )
    out = Counter()
    for source, weight in weights(round(a, mixing.DECIMALS)).items():
        quota = math.floor(weight * total * (1 + 1e-12))
        passes, rest = divmod(quota, own[source])
        place = lambda d: hashlib.md5(f"0:{passes}:{d[0]}".encode()).hexdigest()
        rows = sorted((d for d in counted if d[1] == source), key=place)
        for d in rows:
            out.update({(d[0], e): 1 for e in range(passes)})
        for d in rows:
            rest -= d[2]
            if rest < 0:
                break
            out[d[0], passes] += 1
    return out


def test_pipeline(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = without_items(one_of_each(by_rules(docs)), items)
    assert 0 < len(kept) < len(docs)
    for d in kept:
        assert bool(base_by_hand(d["text"])) == (secrets.redacted(d["text"]) != d["text"])
        d["text"] = secrets.redacted(d["text"])
    expected = mixture(kept)
    found = corpus_pipeline.run(spark, FOLDER)
    rows = found.collect()
    assert Counter((r["doc_id"], r["mix_epoch"]) for r in rows) == expected
    texts = {d["doc_id"]: d["text"] for d in kept}
    assert all(r["text"] == texts[r["doc_id"]] and r["n_chars"] == len(r["text"]) for r in rows)
