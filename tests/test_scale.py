"""Shapes of plans and expressions on which the work of a row or of a task depends."""

import random

from pyspark.sql import functions as F

from postwright import fixed
from postwright.functions import fields, phrases, sql, text
from postwright.functions.coerce import strip
from postwright.operators import postings, skills
from postwright.operators.shaping import ROWS_PER_TASK, fill_cores, tasks_for
from postwright.plans import structure as plans
from postwright.session import COMPILED_BYTES, compiled
from postwright.streaming import incremental
from workload import queries


def test_windows_read_single_words(spark):
    # a slice reads the whole array for every window
    assert "slice(" not in phrases.windows("ws", range(1, 7))
    rng = random.Random(4)
    words = [rng.choice(["blue", "bolt", "hot", "gear", "r2"]) for _ in range(40)]
    df = spark.createDataFrame([(words,), (words[:1],), ([],)], "ws array<string>")
    got = [r[0] for r in df.select(F.expr(phrases.windows("ws", [1, 3, 6]))).collect()]
    for ws, found in zip((words, words[:1], []), got, strict=True):
        assert found == [" ".join(ws[k:k + n]) for n in (1, 3, 6) for k in range(len(ws) - n + 1)]


def test_phrase_arrays_are_built_once(spark):
    df = spark.createDataFrame([(1, "blue bolt"), (2, ""), (3, None)], "doc_id int, text string")
    found = skills.phrase_arrays(df.repartition(3), ["doc_id"], text="text").filter("size(phrases) > 0")
    assert found.collect() == [(1, ["blue", "bolt", "blue bolt"])]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct") == 1


def test_tasks_follow_the_rows(spark):
    assert tasks_for(0, 4) == tasks_for(ROWS_PER_TASK, 4) == 4
    assert tasks_for(10 * ROWS_PER_TASK + 1, 4) == 11
    rows = spark.range(0, 5 * ROWS_PER_TASK + 1, 1, 5)
    assert fill_cores(rows).rdd.getNumPartitions() == 6
    assert fill_cores(rows, F.col("id") % 3).rdd.getNumPartitions() == 6


def test_postings_keep_their_tasks_behind_the_join(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("postwright.operators.shaping.ROWS_PER_TASK", 10)
    monkeypatch.setattr(tasks_for, "__defaults__", (10,))
    orders = spark.range(200).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"),
        F.lit("2024-01-02").alias("o_orderdate"),
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(7).select(F.col("id").alias("p_partkey"), F.lit("blue bolt").alias("p_name")).write.parquet(
        f"{tmp_path}/part.parquet"
    )
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            made = queries.views.postings(spark, str(tmp_path))
            assert made.rdd.getNumPartitions() == 20 and made.count() == 200
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_file_of_postings_is_not_joined_in_one_task(spark, tmp_path, monkeypatch):
    spark.range(20).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"),
        F.lit("2024-01-02").alias("o_orderdate"),
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(7).select(F.col("id").alias("p_partkey"), F.lit("blue bolt").alias("p_name")).write.parquet(
        f"{tmp_path}/part.parquet"
    )
    written = []
    write = queries.sinks.write_table
    monkeypatch.setattr(queries.sinks, "write_table", lambda df, *a, **k: (written.append(df), write(df, *a, **k)))
    assert queries.scan_postings_lines(spark, str(tmp_path)).count() == 20
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 1, true" in plan and "Repartition 1, false" not in plan


def test_ascii_texts_are_cleaned_like_others(spark):
    texts = [
        "Call (303) 555-1234 or see https://x.example/1 now", "WWW.A.EXAMPLE/x", "* one\n\t- two\n+three\n + four",
        "a  b\tc\x0bd", "&lt;b&gt; &amp;amp; &nbsp;x &copy;", "PAY $15.50 - $30 PER HOUR, Ph.D, two to five yrs of work experience",
        "45k-99k/yr, 3+ YEARS experience, M.B.A. or GED, full-time", "$5 monthly then 70k year", "an expert of many years",
    ]
    rows = [(2 * k + odd, t + (" \u00e9" if odd else " e")) for k, t in enumerate(texts) for odd in (0, 1)]
    df = spark.createDataFrame(rows, "id int, description string")
    got = {r["id"]: r.asDict() for r in postings.structure_fields(df).collect()}
    for k in range(len(texts)):
        plain, other = got[2 * k], got[2 * k + 1]
        assert plain["description_clean"][:-1] == other["description_clean"][:-1]
        for name in postings.EXTRACTED:
            assert plain[name] == other[name], (texts[k], name)
    assert got[10]["salary_text_min"] == 15.5 and got[10]["experience_min_years"] is not None
    assert text.ascii_only("t") in text.mask_phones("t")


def test_batch_of_one_file_is_cleaned_by_all_cores(spark, tmp_path):
    rows = spark.range(40).select(
        F.col("id").cast("string").alias("system_job_id"), F.lit("a blue bolt").alias("description")
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    taxonomy = spark.createDataFrame(
        [("blue bolt", "bolts", "d", "esco", 0.9)],
        "raw_skill string, taxonomy_skill string, taxonomy_description string, "
        "taxonomy_source string, correlation double",
    )
    incremental.structure_stream(
        spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"),
        skills.build_lookup(taxonomy), f"{tmp_path}/out", f"{tmp_path}/check", buckets=2,
    ).awaitTermination()
    staged = spark.read.parquet(f"{tmp_path}/check-stage/postings")
    assert staged.select(F.input_file_name()).distinct().count() == 4
    assert staged.select("system_job_id").distinct().count() == 40
    assert spark.read.parquet(f"{tmp_path}/out/structured_skills").count() == 40


def test_patterns_behind_a_look_ahead_match_the_same(spark):
    rng = random.Random(7)
    pieces = [
        "full-time", "part  time", "contract", "temp", "gig", "intern", "co-op", "wfh", "Remote", "PTO",
        "dental", "401k", "paid leave", "tuition assist", "relocation package", "sign-on bonus",
        "Ph.D", "phd", "m.a.", "MBA", "m.eng", "ms", "master's", "b.s", "BA", "four year", "4-year college",
        "a.a.s", "two year", "GED", "high  school", "hsed", "x", "_ma", "ma1", "ſ", "\t", " \t", "\r", "  ",
        "www.a.b", "HTTPS://x", "(303) 555-1234", "303.555.12345", "$5 - $9 per hour", "50k-60k yr",
        "two years experience", "3+ yrs of experience", "&amp;lt;", "&lt;", "&amp;", "&x", "&",
    ]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " ", ", "]) for _ in range(6)) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = df.selectExpr("t", "lower(t) AS _low", f"{sql.ascii_only('t')} AS _ascii", "true AS _odd")
    tiers = dict(fixed.EDUCATION_TIERS)
    assert fields._TIER_HINTS.keys() == tiers.keys()  # none is searched for in every text
    for name, pattern in (fixed.FLAGS | tiers).items():
        hints = (fields._FLAG_HINTS | fields._TIER_HINTS)[name]
        for odd in ("_odd", "NOT _ascii AND t LIKE '%ſ%'"):
            found = fields._matches("t", pattern, hints, fields._STARTS[name]).replace("_odd", f"({odd})")
            plain = f"t RLIKE {sql.quote('(?iU)' + pattern)}"
            assert df.filter(f"({found}) <> ({plain})").count() == 0, name
    for pattern, starts in (
        (fixed.SALARY_DOLLAR, "$"), (fixed.SALARY_K, r"\d"), (fixed.EXPERIENCE, r"\dotfsen"),
    ):
        plain = f"nullif(regexp_extract(t, {sql.quote('(?iU)' + pattern)}, 0), '')"
        assert df.filter(f"NOT ({fields._first('t', pattern, starts)} <=> {plain})").count() == 0
    swap = lambda pattern, by: f"regexp_replace(t, {sql.quote(pattern)}, '{by}')"
    for step, plain in (
        (text.mask_urls, swap("(?iU)" + fixed.URL, " <URL> ")),
        (text.mask_phones, swap("(?U)" + fixed.PHONE, " <PHONE> ")),
        (text.collapse_blanks, swap(fixed.HORIZONTAL_SPACE, " ")),
    ):
        assert df.filter(f"{step('t')} <> {plain}").count() == 0, step
    decoded = [r[0] for r in df.selectExpr(text._decode_common("t")).collect()]
    assert decoded == [t.replace("&lt;", "<").replace("&amp;", "&") for t in texts]


def test_postings_are_staged_in_methods_that_the_jvm_compiles(spark, tmp_path, monkeypatch):
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    write = plans.stored

    def noted(df, path):
        seen.append(spark.conf.get(name))
        return write(df, path)

    monkeypatch.setattr(plans, "stored", noted)
    before = spark.conf.get(name)
    rows = [("1", " We pay $20 per hour, full time. ")]
    df = spark.createDataFrame(rows, "system_job_id string, description string")
    staged = plans._staged(df, str(tmp_path / "staged"), plans.Rules())
    assert seen == [COMPILED_BYTES]
    assert staged.select("salary_text_min", "is_fulltime").collect() == [(20.0, True)]
    assert spark.conf.get(name) == before


def test_the_limit_of_methods_is_put_back(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, "12345")
    try:
        with compiled(spark):
            assert spark.conf.get(name) == COMPILED_BYTES
            raise KeyError
    except KeyError:
        assert spark.conf.get(name) == "12345"
    finally:
        spark.conf.unset(name)


def test_ends_are_stripped_only_where_they_are_white_space(spark):
    bodies = ["", "x", "a b", "\u00e9t\u00e9", "\U0001f600", "\u2060x\u2060"]
    texts = [None, *fixed.SPACE_CHARACTERS]
    texts += [l + b + r for b in bodies for l in ("", *fixed.SPACE_CHARACTERS) for r in ("", " ", "\u3000\n")]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    quick, plain = text.strip_ends("t"), strip("t")
    got = df.select("t", F.expr(quick).alias("quick"), F.expr(plain).alias("plain")).collect()
    assert all(r.quick == r.plain == (None if r.t is None else r.t.strip(fixed.SPACE_CHARACTERS)) for r in got)
    assert text.TIDY_LAYOUT[-1] is text.strip_ends
