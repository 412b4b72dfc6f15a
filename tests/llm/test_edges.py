"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postwright.llm import (
    decontaminate, html_wrapper, langid, licenses, line_rules, minhash, mixing, secrets, toxicity,
    warc,
)

LONG = " ".join(f"word{k}" for k in range(40_000))
TEXTS = [
    (1, "one two three four five six seven eight nine ten eleven twelve", "en", "a"),
    (1, "one two three four five six seven eight nine ten eleven twelve", "en", "a"),
    (2, None, None, None), (3, "", "en", "a"), (4, LONG, "en", "b"), (None, "no id here", "de", "b"),
    (5, " \n\t ", "en", None), (6, "...", None, "b"),
]
# the names that operators use themselves
CLASHING = [
    "n_words", "kept", "score", "spans", "component", "w", "b", "n", "host", "lines", "node",
    "size", "token", "q_source", "n_tokens", "_text", "y", "id", "template", "t", "o_digest",
    "l_key", "payload", "words", "held_out", "contaminated",
]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(*r, len(r[1]) if r[1] else 0) for r in TEXTS]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    df = spark.createDataFrame(rows, schema)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "seven eight nine"), (2, None), (3, ""), (3, ""), (None, "one two"), (4, "?!")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (1, 1, 0), (2, 0, None), (None, 1, 1), (4, 1, 1), (3, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def pages(spark):
    body = "<html><body><nav>x</nav><p>" + "long text " * 20 + "</p></body></html>"
    rows = [
        (1, "http://a.example/1", body), (2, "http://a.example/2", body), (2, None, body),
        (3, "http://a.example/3", None), (4, "", ""), (None, "x", "<<<p>broken <b>text"),
        (5, "http://b.example/", "<div>" * 3000 + "deep" + "</div>" * 10),
        (6, "http://b.example/", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 9),
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


def per_document(documents, benchmark, labels):
    return {
        "near": lambda d: minhash.components_of(d),
        "toxicity": lambda d: toxicity.score(d, labels),
        "leaks": lambda d: decontaminate.scan(d, benchmark),
        "secrets": lambda d: secrets.scan(d),
        "lines": lambda d: line_rules.measure(d),
        "language": lambda d: langid.identify(d),
    }


@pytest.mark.parametrize("name", ["near", "toxicity", "leaks", "secrets", "lines", "language"])
def test_one_row_per_document(documents, benchmark, labels, name):
    make = per_document(documents, benchmark, labels)[name]
    found = [r["doc_id"] for r in make(documents).collect()]
    assert sorted(found, key=str) == sorted([t[0] for t in TEXTS], key=str)
    assert make(documents.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["near", "toxicity", "leaks", "secrets", "lines", "language"])
def test_other_columns_do_not_matter(documents, benchmark, labels, name):
    make = per_document(documents, benchmark, labels)[name]
    plain = make(documents.drop(*CLASHING)).drop("_row", "component")
    key = lambda rows: sorted(map(str, rows))
    assert key(make(documents).drop("_row", "component").collect()) == key(plain.collect())


def test_pages(pages):
    found = html_wrapper.extract(pages).collect()
    by_id = {r["page_id"]: r for r in found}
    assert len(found) == 8
    assert by_id[3]["text"] == by_id[4]["text"] == ""
    assert by_id[None]["text"].endswith("broken text")
    assert by_id[5]["text"] == "deep"
    assert html_wrapper.extract(pages.limit(0)).collect() == []


def test_archives(pages):
    found = warc.archive(pages).collect()
    assert len(found) == 8
    kinds = sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"])) for r in found)
    assert [k for k in kinds if k[1] == "revisit"] == [("2", "revisit", "1")] * 2
    assert {r["payload_bytes"] for r in found if r["page_id"] in (3, 4)} == {0}
    assert warc.archive(pages.limit(0)).collect() == []


def test_licences(documents):
    assert licenses.scan(documents).collect() == []
    assert licenses.scan(documents.limit(0)).collect() == []


def test_mixing(documents):
    names = documents.columns
    found = mixing.mix(documents)
    assert found.columns[: len(names)] == names
    rows = found.collect()
    assert all(r["mix_weight"] > 0 for r in rows)
    assert mixing.mix(documents.limit(0)).collect() == []
    again = mixing.mix(documents.withColumn("mix_order", F.lit(1)))
    assert again.columns == found.columns


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stage(spark, documents, benchmark, tmp_path, stage):
    name, step = stage
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    found = step(spark, documents, str(tmp_path))
    assert found.columns[: len(documents.columns)] == documents.columns
    if name != corpus_pipeline.STAGES[-1][0]:
        assert found.dtypes == documents.dtypes
    ids = [r["doc_id"] for r in found.collect()]
    expected = {
        "quality rules": [1, 1, 4], "near-duplicates": [1, 2, 3, 4, None, 5, 6],
        # the text without an id holds no item
        "benchmark decontamination": [2, 3, 4, None, 5, 6],
        "secret scans": [t[0] for t in TEXTS],
    }.get(name)
    if expected is not None:
        assert sorted(map(str, ids)) == sorted(map(str, expected))
    assert step(spark, documents.limit(0), str(tmp_path)).collect() == []
