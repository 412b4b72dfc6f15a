import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postwright import fixed
from postwright.functions import phrases
from postwright.operators import mapping, similarity, skills, taxonomy
from postwright.operators.shaping import Skew, find_skew, fill_cores, join_spread, measured, probe

ID, KEY = skills.ID, skills.ROW_KEY
TAX = "research_id string, raw_skill string, taxonomy_skill string, taxonomy_description string, " \
      "taxonomy_source string, correlation double"

WORDS = "data python cloud sql team sales care nurse weld java lead plan risk test build".split()


def make_taxonomy(n=60, seed=3):
    rng = random.Random(seed)
    return [
        (
            f"r{i % 7}",
            " ".join(rng.sample(WORDS, rng.randint(1, 3))),
            None if i == 5 else " ".join(rng.sample(WORDS, 2)),
            None if i % 9 == 0 else "the " + " ".join(rng.choices(WORDS, k=rng.randint(1, 12))),
            "esco",
            rng.randint(30, 100) / 100,
        )
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def tax(spark):
    return spark.createDataFrame(make_taxonomy(), TAX)


@pytest.fixture(scope="module")
def lookup(tax):
    return skills.build_lookup(taxonomy.clean_taxonomy(tax, 0.4))


def posts(spark, texts, ids=None):
    ids = ids or [str(i) for i in range(len(texts))]
    rows = [(k, i, t) for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, f"{KEY} long, {ID} string, description_clean string")


def py_tokens(text):
    pieces = re.split(r"[\s,;:()\[\]{}'\"]+", text.lower())
    return [t for t in pieces if len(t) >= 2 and t not in fixed.SKILL_STOPWORDS]


def py_phrases(text):
    t = py_tokens(text)
    out = {" ".join(t[i:j]) for i in range(len(t)) for j in range(i + 1, min(i + 6, len(t)) + 1)}
    return {p for p in out if len(p) >= 3}


def test_tokens_and_phrases(spark):
    texts = [
        "knowledge of Python, SQL.", "project and management", "", "a b c", "x yy\x1czz  q",
        "one two three four five six seven", "ab ab ab", "C# and R or .NET's (core)",
    ]
    df = posts(spark, texts).select(
        KEY,
        F.expr(phrases.skill_tokens("description_clean")).alias("tokens"),
        F.expr(phrases.skill_phrases(phrases.skill_tokens("description_clean"))).alias("phrases"),
    )
    for row in df.collect():
        text = texts[row[KEY]]
        assert row.tokens == py_tokens(text)
        assert len(row.phrases) == len(set(row.phrases)) and set(row.phrases) == py_phrases(text)


def brute_skills(texts, lookup_rows, min_confidence, max_skills):
    table = {r.phrase: r for r in lookup_rows}
    out = []
    for key, text in enumerate(texts):
        best = {}
        for phrase in py_phrases(text):
            row = table.get(phrase)
            if row is None or phrase in fixed.BENEFIT_NOISE or row.correlation < min_confidence:
                continue
            cand = (-round(row.correlation, 4), phrase)
            if row.taxonomy_skill not in best or cand < best[row.taxonomy_skill]:
                best[row.taxonomy_skill] = cand
        ranked = sorted((c, s is None, s or "", p) for s, (c, p) in best.items())[:max_skills]
        out += [(str(key), p, None if none else s, -c) for c, none, s, p in ranked]
    return Counter(out)


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("max_skills", [2, 20])
def test_map_postings_equals_brute_force(spark, lookup, limit, max_skills):
    rng = random.Random(1)
    texts = [" ".join(rng.choices(WORDS + ["and", "dental"], k=rng.randint(0, 30)))
             for _ in range(80)]
    got = skills.map_postings(posts(spark, texts), lookup, 0.5, max_skills, limit=limit)
    rows = Counter((r[ID], r.raw_skill, r.taxonomy_skill, r.confidence) for r in got.collect())
    assert rows == brute_skills(texts, lookup.table.collect(), 0.5, max_skills)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" if limit is None else "_salt") in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_noise_and_threshold(spark):
    rows = [
        ("r", "dental", "teeth", "d", "esco", 0.9), ("r", "low skill x", "low", "d", "esco", 0.45),
        ("r", "dental assistant", "assist", "d", "esco", 0.7),
        ("r", "aid dentist", "assist", "d", "esco", 0.7), ("r", None, "none", "d", "esco", 0.9),
    ]
    lookup = skills.build_lookup(spark.createDataFrame(rows, TAX))
    assert lookup.rows == 4
    df = posts(spark, ["dental assistant, aid dentist", "dental"])
    got = skills.map_postings(df, lookup, 0.5).collect()
    assert [(r[ID], r.raw_skill, r.confidence) for r in got] == [("0", "aid dentist", 0.7)]


def test_empty_lookup(spark):
    lookup = skills.build_lookup(spark.createDataFrame([], TAX))
    assert skills.map_postings(posts(spark, ["python"]), lookup).count() == 0


# ------------------------------------------------------------------ similarity


def grams(text):
    words = [w for w in re.findall(r"\w\w+", text.lower())]
    return Counter(" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))


def brute_index(docs, cap):
    counts = [grams(d) for d in docs]
    total, df = Counter(), Counter()
    for c in counts:
        total.update(c)
        df.update(c.keys())
    kept = sorted(total, key=lambda t: (-total[t], t))[:cap]
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in kept}
    return idf, [unit(c, idf) for c in counts]


def unit(counts, idf):
    v = {t: (1 + math.log(n)) * idf[t] for t, n in counts.items() if t in idf}
    norm = math.sqrt(sum(w * w for w in v.values()))
    return {t: w / norm for t, w in v.items()} if norm else {}


@pytest.mark.parametrize("cap", [None, 40])
@pytest.mark.parametrize("min_confidence,top_k", [(0.4, 1), (0.2, 3), (0.0, 2), (0.7, 5)])
def test_similarity_equals_brute_force(spark, tax, cap, min_confidence, top_k):
    index = similarity.build_index(tax, cap)
    docs = similarity.corpus(tax).collect()
    idf, vectors = brute_index([d.text for d in docs], cap)
    assert {r.term: r.idf for r in index.vocabulary.table.collect()} == pytest.approx(idf)
    rng = random.Random(7)
    asked = sorted({" ".join(rng.choices(WORDS + ["the", "zzz"], k=rng.randint(1, 6)))
                    for _ in range(150)})
    expected = set()
    for phrase in asked:
        v = unit(grams(phrase), idf)
        scored = []
        for d, w in zip(docs, vectors):
            cosine = round(sum(v[t] * w.get(t, 0.0) for t in v), 9)
            if cosine >= 0.01:
                scored.append((-cosine, d.taxonomy_skill is None, d.taxonomy_skill or "", d))
        scored.sort(key=lambda s: s[:3])
        for cosine, _, _, d in scored[:top_k]:
            if -cosine * d.correlation >= min_confidence:
                expected.add((phrase, d.taxonomy_skill, round(-cosine * d.correlation, 4)))
    df = spark.createDataFrame([(p,) for p in asked], "phrase string")
    for limit in (None, 0):
        got = similarity.similar_skills(df, index, min_confidence, top_k, limit).collect()
        got = {(r.raw_skill, r.taxonomy_skill, r.confidence) for r in got}
        assert {g[:2] for g in got} == {e[:2] for e in expected}
        for phrase, skill, c in got:
            assert any(e[:2] == (phrase, skill) and abs(e[2] - c) < 2e-4 for e in expected)


def test_mapping_sends_only_unknown_phrases_to_similarity(spark, tax, lookup):
    index = similarity.build_index(taxonomy.clean_taxonomy(tax, 0.4))
    known = lookup.table.first().phrase
    rows = [(1, "1", known), (1, "1", "python cloud plan"), (2, "2", "qqq zzz")]
    df = spark.createDataFrame(rows, f"{KEY} long, {ID} string, phrase string")
    got = mapping.map_to_taxonomy(df, lookup, index, 0.1).collect()
    assert {r.raw_skill: r.match_method for r in got} == {
        known: "exact", "python cloud plan": "tfidf"
    }


def test_external_candidates(spark):
    cols = f"{KEY} long, {ID} string, phrase string"
    vocab = spark.createDataFrame([(1, "a", "python")], cols)
    extra = spark.createDataFrame(
        [(1, "a", "python"), (1, "a", "ab"), (1, "a", "skills"), (1, "a", "dental"),
         (1, "a", "new thing")], cols)
    got = skills.union_candidates(vocab, extra).collect()
    assert sorted(r.phrase for r in got) == ["new thing", "python"]


# ------------------------------------------------------------------ skew and size


def test_join_spread_under_skew(spark):
    ids = ["hot"] * 4000 + [None] * 4000 + [str(i) for i in range(4000)]
    left = spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "id string, k long")
    right = spark.createDataFrame([("hot", 1), ("7", 2), ("x", 3)], "id string, v int")
    skew = find_skew(left, "id")
    assert skew == Skew(["hot"], True)
    expected = Counter((i, k, {"hot": 1, "7": 2}.get(i)) for k, i in enumerate(ids))
    got = join_spread(left, right, "id", ["k"])
    assert Counter(map(tuple, got.select("id", "k", "v").collect())) == expected
    inner = join_spread(left, right, "id", ["k"], "inner")
    assert inner.count() == 4001
    # many tasks take part in the join of the hot key
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = join_spread(left, right, "id", ["k"]).filter("id = 'hot' or id is null")
        assert parts.select(F.spark_partition_id()).distinct().count() > 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_probe_is_the_same_with_and_without_broadcast(spark, how):
    left = spark.createDataFrame([(i % 5, i) for i in range(500)], "p int, k int")
    right = measured(spark.createDataFrame([(1, "a"), (3, "b"), (9, "c")], "p int, v string"))
    small = probe(left, right, "p", ["k"], how)
    large = probe(left, right, "p", ["k"], how, limit=0)
    assert small.columns == large.columns
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, large.collect()))
    right.release()


def test_summary_of_repeated_ids(spark):
    cols = f"{ID} string, taxonomy_skill string, confidence double"
    long = spark.createDataFrame(
        [("a", "s1", 0.5), ("a", "s1", 0.9), ("a", "s2", 0.9), ("a", None, 0.99),
         ("a", "s3", 0.1), ("a", "s4", 0.2), (None, "s1", 0.9)], cols)
    jobs = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], f"{ID} string, n int")
    got = skills.attach_summary(jobs, long).orderBy("n").collect()
    assert [tuple(r) for r in got] == [
        ("a", 1, 6, "s1 | s2 | s4"), ("a", 2, 6, "s1 | s2 | s4"), ("b", 3, 0, ""), (None, 4, 0, "")
    ]


def test_fill_cores_only_widens(spark):
    small = spark.range(10).coalesce(1)
    assert fill_cores(small).rdd.getNumPartitions() == 4
    wide = spark.range(0, 100, 1, 9)
    assert fill_cores(wide).rdd.getNumPartitions() == 9


def test_skill_invariants(spark, lookup):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(WORDS, k=40)) for _ in range(60)]
    df = posts(spark, texts)
    long = skills.map_postings(df, lookup, 0.4, 3)
    again = skills.map_postings(df.repartition(9), lookup, 0.4, 3)
    rows = long.collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again.collect()))
    assert all(0.4 <= r.confidence <= 1 for r in rows)
    per_job = Counter(r[ID] for r in rows)
    assert max(per_job.values()) <= 3
    assert max(Counter((r[ID], r.taxonomy_skill) for r in rows).values()) == 1
    jobs = skills.attach_summary(df, long).collect()
    assert len(jobs) == 60 and all(r.skill_count == per_job[r[ID]] for r in jobs)
