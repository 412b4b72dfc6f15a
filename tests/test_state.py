"""Latest sendings in buckets, sums of reports, and outputs that appear together."""

import pytest

from postwright import build_lookup, published, run, running_report, scan_taxonomy
from postwright.operators import report
from postwright.operators.postings import ROW_KEY
from postwright.session import exists, folders
from postwright.sinks import runs
from postwright.streaming import incremental, state

JOBS = f"system_job_id string, title string, skill_count bigint, {ROW_KEY} bigint"
SKILLS = "system_job_id string, raw_skill string, taxonomy_skill string, confidence double"


def batch(spark, sent):
    """A batch of (id, title, skills)."""
    jobs = [(i, t, len(s), k) for k, (i, t, s) in enumerate(sent)]
    skills = [(i, x, x.upper(), 0.5) for i, _, s in sent for x in s]
    return spark.createDataFrame(jobs, JOBS), spark.createDataFrame(skills, SKILLS)


def rows(held):
    jobs = sorted((r.system_job_id or "", r.title) for r in held.jobs.collect())
    skills = sorted((r.system_job_id or "", r.raw_skill) for r in held.skills.collect())
    return jobs, skills


def latest(sendings):
    last = {}
    for n, sent in enumerate(sendings):
        for i, *_ in sent:
            if i is not None:
                last[i] = n
    kept = [x for n, sent in enumerate(sendings) for x in sent if x[0] is None or last[x[0]] == n]
    return (
        sorted((i or "", t) for i, t, _ in kept),
        sorted((i or "", x) for i, _, s in kept for x in s),
    )


SENDINGS = [
    [("1", "a", ["p", "q"]), ("2", "b", ["p"]), (None, "n", ["z"]), ("3", "c", [])],
    [("2", "b2", []), ("2", "b2 too", ["r"]), (None, "n", ["z"])],
    [("4", "d", ["p"]), ("1", "a2", ["s"])],
    [("1", "a3", []), ("5", "e", ["q"])],
]


@pytest.mark.parametrize("versions", [1, 8])
def test_latest_sendings(spark, tmp_path, versions):
    place = str(tmp_path / "state")
    for n, sent in enumerate(SENDINGS):
        state.advance(spark, place, n, *batch(spark, sent), 4, versions)
        assert rows(state.current(spark, place)) == latest(SENDINGS[: n + 1])
    most = max(len(v) for v in state.index_before(spark, place).values())
    assert most <= versions + 1 if versions == 1 else most > 1
    # a batch that is repeated changes nothing, nor does one that breaks off before its index
    state.advance(spark, place, 3, *batch(spark, SENDINGS[3]), 4, versions)
    assert rows(state.current(spark, place)) == latest(SENDINGS)
    jobs, _ = batch(spark, [("1", "broken", [])])
    jobs.write.parquet(f"{place}/jobs/batch=4/{state.BUCKET}=0")
    assert rows(state.current(spark, place)) == latest(SENDINGS)
    # what is replaced, as the next batch sees it
    jobs, _ = batch(spark, [("1", "x", []), ("9", "y", []), (None, "n", [])])
    gone = state.replaced(spark, place, 4, jobs, 4)
    assert rows(gone) == ([("1", "a3")], [])
    jobs, _ = batch(spark, [("9", "y", []), (None, "n", [])])
    assert state.replaced(spark, place, 4, jobs, 4) is None
    state.vacuum(spark, place)
    assert rows(state.current(spark, place)) == latest(SENDINGS)
    assert len(folders(spark, f"{place}/index")) == 2


def test_one_posting_costs_its_bucket(spark, tmp_path):
    place = str(tmp_path / "state")
    sent = [(str(k), "t", ["p"]) for k in range(200)]
    state.advance(spark, place, 0, *batch(spark, sent), 16)
    state.advance(spark, place, 1, *batch(spark, [("7", "again", ["q"])]), 16)
    index = state.index_before(spark, place)
    assert sorted(len(v) for v in index.values()) == [1] * 15 + [2]
    assert len(folders(spark, f"{place}/jobs/batch=1")) == 1
    assert spark.read.parquet(f"{place}/jobs/batch=1").count() == 1
    assert state.current(spark, place).jobs.count() == 200




def flat(row):
    return {
        k: row[k].asDict() if hasattr(row[k], "asDict") else [tuple(x) for x in row[k]]
        for k in ("cleaning_stats", "totals", "extraction_coverage", "top_20_taxonomy_skills")
    }


def test_running_report_of_files_with_different_headings(spark, tmp_path):
    from postwright import fixed

    (tmp_path / "tax.csv").write_text(
        ",".join(fixed.TAXONOMY_COLUMNS) + "\n"
        "r1,data analysis,analyse data,about data,esco,0.9\nr2,python,python,language,onet,0.8\n"
    )
    lookup = build_lookup(scan_taxonomy(spark, str(tmp_path / "tax.csv"), 0.4))
    folder = tmp_path / "in"
    folder.mkdir()
    out = str(tmp_path / "out")
    files = [
        "system_job_id,title,description\n1,a,Python full-time\n2,b,\"data\nanalysis\"\n,n,Python\n",
        "description,other,system_job_id\nremote data analysis and Python,x,2\n$30 per hour,y,3\n",
    ]
    for k, text in enumerate(files):
        (folder / f"{k}.csv").write_text(text)
        names = incremental.stream_files(spark, str(folder), 1)
        incremental.structure_stream(
            names, lookup, out, str(tmp_path / "ck"), buckets=4
        ).awaitTermination()
    held = state.current(spark, f"{out}/state")
    jobs = sorted((r.system_job_id or "", r.skill_count) for r in held.jobs.collect())
    assert jobs == [("", 0), ("1", 1), ("2", 2), ("3", 0)]
    whole = report.quality_report(held.jobs, held.skills, held.jobs, "description_length")
    assert flat(running_report(spark, out).first()) == flat(whole.first())
    median = incremental.report_parts(spark, out)["lengths"].first()
    assert median == report.description_stats(held.jobs, "description_length").first()


def test_broken_run_leaves_the_earlier_one(spark, tmp_path, monkeypatch):
    from postwright import fixed
    from postwright.sinks import tables as sinks

    (tmp_path / "tax.csv").write_text(
        ",".join(fixed.TAXONOMY_COLUMNS) + "\nr2,python,python,language,onet_tech,0.8\n"
    )
    (tmp_path / "jobs.csv").write_text("system_job_id,description\n1,Python\n")
    out = str(tmp_path / "out")
    arguments = (spark, str(tmp_path / "jobs.csv"), str(tmp_path / "tax.csv"), out)
    assert published(spark, out) == {}
    run(*arguments)
    first = published(spark, out)
    assert set(first) == {"structured_jobs", "structured_skills", "quality_report"}
    (tmp_path / "jobs.csv").write_text("system_job_id,description\n1,Python\n2,Python\n")

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "write_report", broken)
        with pytest.raises(RuntimeError):
            run(*arguments)
    assert published(spark, out) == first
    assert spark.read.csv(first["structured_jobs"], header=True).count() == 1
    run(*arguments)
    now = published(spark, out)
    assert "run=3" in now["structured_jobs"]
    assert spark.read.csv(now["structured_jobs"], header=True).count() == 2
    # the published run before this one stays, older and broken ones between go later
    assert exists(spark, first["structured_jobs"])
    run(*arguments)
    assert not exists(spark, first["structured_jobs"]) and exists(spark, now["structured_jobs"])
    with pytest.raises(ValueError):
        runs.publish(spark, out, 9, ["structured_jobs"])
