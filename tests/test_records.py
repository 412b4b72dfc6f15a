"""CSV files read split by split."""

import csv
import io
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from postwright import scan_postings
from postwright.sources import records, tables

FIELDS = [
    "", "a", 'say "hi"', "x\ny", "a,b", '","', '"', "\n", 'p\n"q",\n', '""', "\r\nz", 'end"',
    ',\n,"', "plain words", "é ü", "  blanks ", "\n\n\n", 'x",\n"y',
]


@contextmanager
def settings(spark, **values):
    names = {k: k.replace("__", ".") for k in values}
    before = {k: spark.conf.get(n, None) for k, n in names.items()}
    for k, n in names.items():
        spark.conf.set(n, values[k])
    try:
        yield
    finally:
        for k, n in names.items():
            spark.conf.unset(n) if before[k] is None else spark.conf.set(n, before[k])


def split_into(spark, n, batch=10_000):
    """Scans take about ``n`` splits, whatever they read."""
    return settings(
        spark, spark__sql__files__minPartitionNum=str(n), spark__sql__files__openCostInBytes="1",
        spark__sql__execution__arrow__maxRecordsPerBatch=str(batch),
    )


def write(path, rows, heading=("a", "b", "c"), **options):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=options.pop("end", "\n"), **options)
        out.writerow(heading)
        out.writerows(rows)


def texts(table):
    return [r["text"] for r in table.orderBy(*records.PLACE).collect()]


def expected_texts(rows, **options):
    out = []
    for row in rows:
        f = io.StringIO()
        csv.writer(f, lineterminator="", **options).writerow(row)
        out.append(f.getvalue())
    return out


def some_rows(seed, n, wild=0.5):
    rng = random.Random(seed)
    return [
        [f"k{i}", *(rng.choice(FIELDS) if rng.random() < wild else f"w{i}" for _ in range(2))]
        for i in range(n)
    ]


@pytest.mark.parametrize("seed,splits,batch,end,quoting", [
    (1, 12, 10_000, "\n", csv.QUOTE_MINIMAL), (2, 20, 2, "\r\n", csv.QUOTE_MINIMAL),
    (3, 30, 1, "\n", csv.QUOTE_ALL), (4, 2, 3, "\r\n", csv.QUOTE_ALL),
])
def test_records_of_any_splits(spark, tmp_path, seed, splits, batch, end, quoting):
    rows = some_rows(seed, 60)
    write(tmp_path / "part.csv", rows, end=end, quoting=quoting)
    with split_into(spark, splits, batch):
        found = records.records(spark, str(tmp_path))
        assert texts(found.table) == expected_texts(rows, quoting=quoting)
        (names, table), = records.by_heading(found)
        assert names == ["a", "b", "c"]
        got = records.parsed(table, names, tables.RECORD_OPTIONS).orderBy(*records.PLACE)
        # an empty field without quotes is null, as everywhere
        plain = [[x or "" for x in r] for r in got.select("a", "b", "c").collect()]
    assert plain == rows


def test_field_over_many_splits(spark, tmp_path):
    long = "\n".join(f'line {k}, "quoted" text' for k in range(400))
    rows = [["1", long, "x"], ["2", "y", "z"], ["3", long, long]]
    write(tmp_path / "part.csv", rows)
    with split_into(spark, 30, 5):
        found = records.records(spark, str(tmp_path))
        assert found.table.select("_block").distinct().count() > 1
        assert texts(found.table) == expected_texts(rows)


def test_one_file_uses_many_tasks_and_is_read_once(spark, tmp_path):
    write(tmp_path / "part.csv", some_rows(5, 400, 0.1))
    with split_into(spark, 16):
        read = records._assembled(spark, str(tmp_path), True)
        assert read.rdd.getNumPartitions() >= 16
        records.records(spark, str(tmp_path), work=str(tmp_path / "work"))
    # one folder per reading
    assert [p.name for p in (tmp_path / "work").iterdir()] == ["0"]


def test_misleading_splits_are_read_again(spark, tmp_path):
    # lines of a quoted field that look like records which end a field
    field = 'a","\n' * 40
    rows = [[f"k{k}", field, "x"] for k in range(20)]
    write(tmp_path / "part.csv", rows)
    write(tmp_path / "plain.csv", [["q", "r", "s"]])
    with split_into(spark, 20, 4):
        found = records.records(spark, str(tmp_path), work=str(tmp_path / "work"))
        assert texts(found.table) == expected_texts([*rows, ["q", "r", "s"]])
    assert {p.name for p in (tmp_path / "work").iterdir()} == {"0", "1", "2"}


def test_quotes_inside_plain_fields_are_text(spark, tmp_path):
    (tmp_path / "part.csv").write_text('a,b\n5" pipe,x\n6" pipe,"y\nz"\n,\n\n"",q\n')
    with split_into(spark, 5):
        found = records.records(spark, str(tmp_path))
        assert texts(found.table) == ['5" pipe,x', '6" pipe,"y\nz"', ",", '"",q']
        (names, table), = records.by_heading(found)
        got = records.parsed(table, names, tables.RECORD_OPTIONS).orderBy(*records.PLACE)
        rows = [tuple(r) for r in got.select("a", "b").collect()]
    assert rows == [('5" pipe', "x"), ('6" pipe', "y\nz"), (None, None), (None, "q")]


def test_headings_of_several_files(spark, tmp_path):
    folder = tmp_path / "with blank"
    folder.mkdir()
    write(folder / "1.csv", [["1", "Cook, chef", "a\nb"]], ("system_job_id", "title", "description"))
    write(folder / "2.csv", [["x\ny", "2", "Nurse"]], ("description", "system_job_id", "title"))
    write(folder / "3.csv", [["3", "z"]], ("﻿system_job_id", "other"))
    write(folder / "4.csv", [])
    (folder / "5.csv").write_text("")
    rows = {r.system_job_id: r for r in scan_postings(spark, str(folder)).collect()}
    assert rows["1"].title == "Cook, chef" and rows["1"].description == "a\nb"
    assert rows["2"].title == "Nurse" and rows["2"].description == "x\ny"
    assert rows["3"].title is None and len(rows) == 3
    one = scan_postings(spark, [str(folder / "2.csv"), str(folder / "1.csv")], sample_size=1)
    assert [r.system_job_id for r in one.collect()] == ["2"]


def test_empty_files_have_no_rows(spark, tmp_path):
    (tmp_path / "1.csv").write_text("")
    assert scan_postings(spark, str(tmp_path)).count() == 0
    assert scan_postings(spark, str(tmp_path), sample_size=3).count() == 0


def test_names_of_headings():
    assert records.names_of('"a,b",c') == ["a,b", "c"]
    assert records.names_of("x,,x") == ["x0", "_c1", "x2"]


@pytest.mark.parametrize("n", [0, 41, 500])
def test_sample_is_the_first_rows_in_file_order(spark, tmp_path, n):
    heading = ("system_job_id", "description", "expired")
    number = iter(range(1000))
    kept = []
    for name, size in (("a", 40), ("b", 55), ("c", 25)):
        rows = [[str(next(number)), "text\n" * (k % 4), "TRUE" if k % 5 == 0 else ""] for k in range(size)]
        kept += [r[0] for r in rows if not r[2]]
        write(tmp_path / f"{name}.csv", rows, heading)
    with split_into(spark, 4):
        got = scan_postings(spark, str(tmp_path), sample_size=n).select("system_job_id").collect()
        assert sorted(int(r[0]) for r in got) == list(range(min(n, 120)))
        active = scan_postings(spark, str(tmp_path), active_only=True, sample_size=n)
        assert sorted(int(r.system_job_id) for r in active.collect()) == [int(x) for x in kept[:n]]


def test_sample_of_parquet_in_file_order(spark, tmp_path):
    df = spark.range(0, 300, 1, 3).select(F.col("id").cast("string").alias("system_job_id"))
    df.write.parquet(str(tmp_path / "in"))
    got = scan_postings(spark, str(tmp_path / "in"), sample_size=130, fmt="parquet")
    assert sorted(int(r.system_job_id) for r in got.collect()) == list(range(130))
