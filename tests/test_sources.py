import datetime as dt
import json
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from postwright import fixed, published, run, scan_postings, scan_taxonomy, validate_inputs
from postwright.functions import coerce
from postwright.operators import postings, report, taxonomy
from postwright.sinks import tables as sinks
from postwright.sources import tables as sources
from postwright.streaming import incremental

NUMBERS = [
    " 5e4 ", "1,000", "1d", "0x10", "5.", ".5", "+5", "-5", "--5", "1_000", "Infinity", "INF",
    " inf ", "-inf", "TRUE", "1e", "1e400", "\t7\n", "5 6", "1E+3", "nan ", " 5", "٣", ".",
    "+.5", "1.e3", "", " ", "1,5", "12", "0012", "1f", "1.5e-3",
]


def test_numbers_equal_pandas(spark):
    df = spark.createDataFrame([(n,) for n in NUMBERS], "t string").coalesce(1)
    got = [r.v for r in df.select("t", F.expr(coerce.to_number("t")).alias("v")).collect()]
    expected = pd.to_numeric(pd.Series(NUMBERS, dtype=object), errors="coerce")
    assert got == [None if math.isnan(x) else x for x in expected]


TIMES = [
    "2024-01-05", "2024-1-5", " 2024-01-05 ", "2024-01-05 10:00", "2024-01-05T10:00:00.123456",
    "2024-01-05T10:00:00Z", "2024-01-05 10:00:00+02:00", "2024-01-05T10:00:00+0200", "20240105",
    "01/02/2024", "1/2/2024 3:04 PM", "01/02/2024 10:00", "Jan 5, 2024", "05-Jan-2024", "2024",
    "unknown", "2024-01-05 10:00+02:00", "2024-01-05 10:00Z", "2024-13-45", "", "2024-02-30 10:00",
]


def test_times_equal_pandas(spark):
    rows = [(i, t) for i, t in enumerate(TIMES)]
    df = spark.createDataFrame(rows, "i int, date_acquired string")
    typed = postings.type_postings(df).withColumn("micros", F.unix_micros("date_acquired"))
    got = [r.micros for r in typed.orderBy("i").collect()]
    expected = [pd.to_datetime(pd.Series([t]), errors="coerce", utc=True).iloc[0] for t in TIMES]
    assert got == [None if pd.isna(x) else x.value // 1000 for x in expected]


def test_booleans_and_active_filter(spark):
    rows = [("a", None), ("b", " TRUE "), ("c", "true"), ("d", "TRUE"), ("e", "yes"), ("f", "false")]
    df = spark.createDataFrame(rows, "system_job_id string, expired string")
    got = dict(postings.prepare_postings(df, active_only=True).collect())
    assert got == {"a": None, "b": True, "e": None, "f": False}


def test_null_tokens(spark):
    df = spark.createDataFrame([(t,) for t in [*fixed.NULL_TOKENS, " NA", "none"]], "title string")
    got = [r.title for r in postings.null_missing(df).collect() if r.title is not None]
    assert sorted(got) == [" NA", "none"]


CSV = '''system_job_id,title,description,extra,expired,parameters_salary_min
 1 ,"A ""quoted"" title","line one
line, two",x,TRUE,5
2,N/A, padded ,y,,
3,plain,,z,FALSE,"1,000"
'''


def test_csv_scan(spark, tmp_path):
    path = tmp_path / "jobs.csv"
    path.write_text(CSV)
    df = scan_postings(spark, str(path))
    rows = {r.system_job_id: r for r in df.collect()}
    assert set(rows) == {"1", "2", "3"} and "extra" not in df.columns
    assert rows["1"].title == 'A "quoted" title' and rows["1"].description == "line one\nline, two"
    assert rows["2"].title is None and rows["2"].description == " padded "
    assert rows["3"].parameters_salary_min is None and rows["3"].description is None
    assert rows["1"].expired is True and rows["2"].expired is None
    assert len({r.posting_key for r in rows.values()}) == 3
    assert scan_postings(spark, str(path), sample_size=2).count() == 2
    assert scan_postings(spark, str(path), active_only=True).count() == 2


def test_several_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("system_job_id,title\n1,x\n")
    (tmp_path / "b.csv").write_text("title,system_job_id,city\ny,2,Here\n")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    rows = scan_postings(spark, paths).select("system_job_id", "title", "city").collect()
    assert sorted(map(tuple, rows)) == [("1", "x", None), ("2", "y", "Here")]
    empty = scan_postings(spark, [])
    assert empty.count() == 0 and set(fixed.POSTING_COLUMNS) <= set(empty.columns)


def test_taxonomy_scan(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        ",".join(fixed.TAXONOMY_COLUMNS) + "\n"
        "r1, Python ,Programming,Desc,esco,0.9\nr1,python,Coding,Desc,esco,0.95\n"
        "r2,java,Programming,,onet_tech,0.59\nr2,sql,Databases,NA,other,bad\n"
    )
    rows = scan_taxonomy(spark, str(path)).collect()
    assert [(r.raw_skill, r.taxonomy_skill, r.correlation) for r in rows] == [
        ("python", "coding", 0.95)
    ]
    raw = sources.raw_taxonomy(spark, str(path))
    stats = taxonomy.taxonomy_stats(raw).first()
    assert tuple(stats) == (4, 2, 1, 1)
    with pytest.raises(Exception):
        taxonomy.rename_taxonomy(raw.drop("raw_skill"))


def test_validation(spark, tmp_path):
    (tmp_path / "j.csv").write_bytes(b"x" * 1048576)
    rows = validate_inputs(spark, str(tmp_path / "j.csv"), str(tmp_path / "no.csv")).collect()
    assert tuple(rows[0]) == ("jobs", "OK", 1.0, None)
    assert rows[1].status == "MISSING" and "no.csv" in rows[1].error


def test_statistics_of_nothing(spark):
    empty = spark.createDataFrame([], "description_clean string")
    assert tuple(report.description_stats(empty).first()) == (0, 0, None, None, None, 0)
    assert set(report.coverage(empty).first()) == {None}


def test_coverage_counts_zero_skills(spark):
    df = spark.createDataFrame([(0, "Yes"), (0, "No")], "skill_count long, is_remote string")
    row = report.coverage(df).first()
    assert (row.skill_coverage_pct, row.jobs_with_skills_pct, row.remote_pct) == (100.0, 0.0, 50.0)
    assert row.salary_coverage_pct is None


def test_csv_sink_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    when = dt.datetime(2024, 1, 5, 10, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame(
        [("1", ' say "hi",\nthere ', True, 1.00005, when), ("2", None, None, None, None)],
        "system_job_id string, title string, is_remote boolean, salary_final_min double, "
        "created_date timestamp",
    )
    sinks.write_table(sinks.format_jobs(df), path)
    import csv
    import glob
    rows = []
    for name in glob.glob(path + "/*.csv"):
        with open(name, newline="") as f:
            rows += list(csv.DictReader(f))
    rows.sort(key=lambda r: r["system_job_id"])
    assert rows[0]["title"] == ' say "hi",\nthere ' and rows[0]["is_remote"] == "Yes"
    assert rows[0]["created_date"] == "2024-01-05 10:00:00+00:00"
    assert float(rows[0]["salary_final_min"]) == 1.0  # half to even
    assert rows[1]["title"] == "" and rows[1]["is_remote"] == ""


TAXONOMY_CSV = (
    ",".join(fixed.TAXONOMY_COLUMNS) + "\n"
    "r1,data analysis,analyse data,about data,esco,0.9\n"
    "r2,python,python,language,onet_tech,0.8\n"
)


HEADINGS = ["system_job_id", "unwanted", "title", "description"]


def posting_csv(ids):
    lines = [",".join(HEADINGS)]
    lines += [f"{i},x,job {i},Python and data analysis {i} $30/hr" for i in ids]
    return "\n".join(lines) + "\n"


def test_whole_run(spark, tmp_path):
    (tmp_path / "jobs.csv").write_text(posting_csv([1, 2, 2]))
    (tmp_path / "tax.csv").write_text(TAXONOMY_CSV)
    out = str(tmp_path / "out")
    run(spark, str(tmp_path / "jobs.csv"), str(tmp_path / "tax.csv"), out, include_description=True)
    jobs = spark.read.csv(published(spark, out)["structured_jobs"], header=True).collect()
    # copies of an id share the summed count
    assert sorted((r.system_job_id, r.skill_count, r.top_3_skills) for r in jobs) == [
        ("1", "2", "analyse data | python"),
        ("2", "4", "analyse data | python"),
        ("2", "4", "analyse data | python"),
    ]
    assert {r.salary_final_min for r in jobs} == {"30.0"}
    assert "description_clean" in jobs[0]
    assert spark.read.csv(published(spark, out)["structured_skills"], header=True).count() == 6
    text = spark.read.text(published(spark, out)["quality_report"], wholetext=True).first()[0]
    summary = json.loads(text)
    assert summary["totals"] == {"total_jobs_processed": 3, "total_skill_mappings": 6}
    assert summary["top_20_taxonomy_skills"][0] == {"taxonomy_skill": "analyse data", "job_count": 3}
    assert summary["input_validation"]["jobs"]["status"] == "OK"
    with pytest.raises(FileNotFoundError):
        run(spark, str(tmp_path / "none.csv"), str(tmp_path / "tax.csv"), out)


def test_stream_equals_batch_and_replays(spark, tmp_path):
    from postwright import build_lookup

    (tmp_path / "tax.csv").write_text(TAXONOMY_CSV)
    lookup = build_lookup(scan_taxonomy(spark, str(tmp_path / "tax.csv"), 0.4))
    folder = tmp_path / "in"
    folder.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")

    def advance():
        raw = incremental.stream_postings(spark, str(folder), 1, HEADINGS)
        incremental.structure_stream(raw, lookup, out, checkpoint).awaitTermination()

    (folder / "a.csv").write_text(posting_csv([1, 2]))
    advance()
    (folder / "b.csv").write_text(posting_csv([3]))
    (folder / "c.csv").write_text(posting_csv([4, 5]))
    advance()
    jobs = spark.read.parquet(out + "/structured_jobs")
    assert sorted((r.system_job_id, r.skill_count) for r in jobs.collect()) == [
        (str(i), 2) for i in range(1, 6)
    ]
    assert jobs.select("batch").distinct().count() == 3
    assert tuple(incremental.running_totals(spark, out).first()) == (5, 10)
    # the same batches once more replace their own folders
    raw = incremental.stream_postings(spark, str(folder), 1, HEADINGS)
    incremental.structure_stream(raw, lookup, out, checkpoint + "-2").awaitTermination()
    assert spark.read.parquet(out + "/structured_jobs").count() == 5
    assert tuple(incremental.running_totals(spark, out).first()) == (5, 10)


def test_folder_of_files_with_other_headers(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("system_job_id,title,description\n1,nurse,x\n")
    (folder / "b.csv").write_text("title,system_job_id\ncook,2\n")
    (folder / "c.csv").write_text("title,system_job_id\nbaker,3\n")
    rows = scan_postings(spark, str(folder)).collect()
    assert sorted((r.system_job_id, r.title, r.description) for r in rows) == [
        ("1", "nurse", "x"), ("2", "cook", None), ("3", "baker", None),
    ]
    stream = incremental.stream_postings(
        spark, str(folder), 1, ["system_job_id", "title", "description"]
    )
    query = stream.writeStream.format("memory").queryName("headings").trigger(availableNow=True)
    with pytest.raises(Exception):
        query.start().awaitTermination()


def test_every_input_is_validated(spark, tmp_path):
    (tmp_path / "j.csv").write_text(posting_csv([1]))
    (tmp_path / "tax.csv").write_text(TAXONOMY_CSV)
    with pytest.raises(FileNotFoundError, match="jobs 2"):
        run(spark, [str(tmp_path / "j.csv"), str(tmp_path / "gone.csv")],
            str(tmp_path / "tax.csv"), str(tmp_path / "out"))


def test_sample_is_drawn_once(spark, tmp_path):
    from postwright import build_lookup, structure

    (tmp_path / "jobs.csv").write_text(posting_csv(range(200)))
    (tmp_path / "tax.csv").write_text(TAXONOMY_CSV)
    lookup = build_lookup(scan_taxonomy(spark, str(tmp_path / "tax.csv"), 0.4))
    sampled = scan_postings(spark, str(tmp_path / "jobs.csv"), sample_size=20)
    both = structure(sampled, lookup)
    jobs = {r.system_job_id for r in both.jobs.collect()}
    assert len(jobs) == 20
    assert {r.system_job_id for r in both.skills.collect()} == jobs


def test_nothing_is_cut_by_default(spark, tmp_path):
    from postwright import Rules, build_lookup, structure

    names = [f"craft{chr(97 + k)}" for k in range(26)]
    long = "alpha bravo charlie delta echo foxtrot golf hotel"
    lines = [f"r,{n},tax {n},about,esco,0.9" for n in [*names, long]]
    (tmp_path / "tax.csv").write_text(",".join(fixed.TAXONOMY_COLUMNS) + "\n" + "\n".join(lines))
    text = "word " * 6000 + " ".join(names) + " " + long
    (tmp_path / "jobs.csv").write_text(f"system_job_id,description\n1,{text}\n")
    lookup = build_lookup(scan_taxonomy(spark, str(tmp_path / "tax.csv"), 0.4))
    prepared = scan_postings(spark, str(tmp_path / "jobs.csv"))
    assert structure(prepared, lookup).skills.count() == 27
    assert structure(prepared, lookup, Rules(max_skills=5)).skills.count() == 5
    assert structure(prepared, lookup, Rules(max_length=1000)).skills.count() == 0


def test_a_posting_sent_again_replaces_the_earlier_one(spark, tmp_path):
    from postwright import build_lookup, merged

    (tmp_path / "tax.csv").write_text(TAXONOMY_CSV)
    lookup = build_lookup(scan_taxonomy(spark, str(tmp_path / "tax.csv"), 0.4))
    folder = tmp_path / "in"
    folder.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    heading = ",".join(HEADINGS) + "\n"
    first = "1,x,one,Python\n2,x,two,Python\n,x,none,Python\n"
    second = "2,x,again,data analysis\n2,x,again,data analysis and Python\n,x,none,no skill\n"
    for name, rows in (("a.csv", first), ("b.csv", second)):
        (folder / name).write_text(heading + rows)
        raw = incremental.stream_postings(spark, str(folder), 1, HEADINGS)
        incremental.structure_stream(raw, lookup, out, checkpoint).awaitTermination()
    both = merged(spark, out)
    jobs = sorted((r.system_job_id or "", r.title, r.skill_count) for r in both.jobs.collect())
    assert jobs == [("", "none", 0), ("", "none", 0), ("1", "one", 1), ("2", "again", 3),
                    ("2", "again", 3)]
    found = sorted((r.system_job_id, r.raw_skill) for r in both.skills.collect())
    assert [f for f in found if f[0] != "nan"] == [
        ("1", "python"), ("2", "data analysis"), ("2", "data analysis"), ("2", "python"),
    ]
