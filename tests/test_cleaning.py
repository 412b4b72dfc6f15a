import html
import random
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postwright import fixed
from postwright.functions import text


def cleaned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    rows = text.clean_description(df, "t", "c").select("i", "c").collect()
    return [c for _, c in sorted(rows)]


GOLDEN = [
    (None, ""),
    ("   ", ""),
    ("call (303) 555-1234 now", "call <PHONE> now"),
    ("id 123456789012", "id <PHONE> 12"),
    ("a5551234567@x.com", "a <PHONE> @x.com"),
    ("www.a@b.com x", "<URL> x"),
    ("WWW.A.com and HTTP://b", "<URL> and <URL>"),
    ("mail jo.e+x@my-host.org now", "mail <EMAIL> now"),
    ("a < b and c > d", "a d"),
    ("x\n\n * a\n- b", "x\n\na\n\nb"),
    ("x\r- b", "x - b"),
    ("&lt;b&gt;x&lt;/b&gt;", "x"),
    ("①ﬁ", "1fi"),
    ("a&nbsp;&nbsp;b c", "a b c"),
    ("one\t \ttwo\x0bthree", "one two three"),
    ("a\n\n\n\n\nb", "a\n\nb"),
    ("AT&amp;T &amp;lt; R&D", "AT&T R&D"),
    ("wait&hellip; or…", "wait... or..."),
    ("<" + "y" * 200 + ">z", "z"),
    ("<" + "y" * 201 + ">z", "<" + "y" * 201 + ">z"),
    ("　 wide \x1c", "wide"),
    ("éa", "éa"),
    ("&copy 2020 &notit; &#x41;", "© 2020 ¬it; A"),
]


def test_golden(spark):
    assert cleaned(spark, [t for t, _ in GOLDEN]) == [c for _, c in GOLDEN]


def test_truncates_before_decoding(spark):
    long = "a" * 30_000 + "&amp;tail"
    assert cleaned(spark, [long]) == ["a" * 30_000 + "&tail"]
    df = text.clean_description(spark.createDataFrame([(long,)], "t string"), "t", "c", 30_004)
    assert df.first()["c"] == "a" * 30_000 + "&"


def by_library(value):
    """The markup steps with the standard library alone."""
    value = re.sub(fixed.HTML_TAG, " ", html.unescape(value))
    return unicodedata.normalize("NFKC", re.sub(fixed.HTML_ENTITY, " ", value))


def decoded(spark, texts):
    """Decoding, markup and NFKC only, with the native and the fallback path mixed."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    found = df.withColumn("_rare", F.expr(text._rare("t")))
    steps = (text._decode_common, *text.STRIP_MARKUP, text._normalise_common)
    native = text.chain(found, "t", steps, "t")
    rows = native.select("i", F.coalesce(text._decoder()("_rare"), "t").alias("c")).collect()
    return [c for _, c in sorted(rows)]


PIECES = [
    "&", "&amp;", "&lt;", "&gt;", "&nbsp;", "&nbsp", "&#39;", "&#x27;", "&#160;", "&copy;", "&copy",
    "&amp;lt;", "&amp;amp;", "&bogus;", "&é;", "amp;", "lt;", "#39;", "<b>", "</b>", "<", ">", ";",
    "x", " ", "\n", "\t", "é", "é", "́", "ﬁ", "½", "…", "’", "–", "•", "·", " ",
    "‑", "´", "Å", "Å", "\U0001f600", "中", "ﾊﾟ",
]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=8).map("".join), min_size=150,
                max_size=200))
def test_markup_equals_library(spark, texts):
    assert decoded(spark, texts) == [by_library(t) for t in texts]


def test_every_named_entity(spark):
    from html.entities import html5

    texts = [f"a&{name}b &{name}" for name in html5]
    random.Random(1).shuffle(texts)
    assert decoded(spark, texts) == [by_library(t) for t in texts]


def test_every_character_of_the_plain_ranges(spark):
    texts = [chr(c) for c in range(1, 0x2100)] + [f"x{chr(c)}́y" for c in range(0x20, 0x400)]
    assert decoded(spark, texts) == [by_library(t) for t in texts]


def test_pages_equal_library(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = pages.select("html").collect()
    assert decoded(spark, [r.html for r in rows]) == [by_library(r.html) for r in rows]


@pytest.mark.parametrize("partitions", [1, 7])
def test_partitioning_changes_nothing(spark, partitions):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(partitions)
    out = text.clean_description(df, "text", "c").select("doc_id", "c").collect()
    again = text.clean_description(df.coalesce(1), "text", "c").select("doc_id", "c").collect()
    assert sorted(out) == sorted(again)
    for _, c in out:
        for tag in re.findall(fixed.HTML_TAG, c):
            assert tag in ("<URL>", "<PHONE>", "<EMAIL>")
