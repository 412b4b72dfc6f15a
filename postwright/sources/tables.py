"""Readers.  Everything is read as text and typed afterwards."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postwright import fixed
from postwright.functions.coerce import null_tokens, to_number
from postwright.operators import postings, taxonomy
from postwright.operators.shaping import PLACE, fill_cores
from postwright.session import work_path
from postwright.sources import records

# doubled quotes inside quoted fields, blanks kept
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
# a record has been put together, so a line feed in it is part of a field
RECORD_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}

#: Files read at first for a sample, and how many more the next time.
FIRST_FILES = 1
MORE_FILES = 4


def _read_csv(
    spark: SparkSession, path: str | Sequence[str], multi_line: bool, work: str | None
) -> DataFrame:
    """Rows of CSV files with their places; columns of files with other headings are matched by name.

    The files are read once, split by split (see ``records``), and their records
    stored in the work folder.
    """
    found = records.records(spark, path, multi_line, work)
    tables = [
        records.parsed(table, names, RECORD_OPTIONS) for names, table in records.by_heading(found)
    ]
    return postings.union_sources(tables) if tables else spark.createDataFrame([], "_file string")


def _read(
    spark: SparkSession, path: str | Sequence[str], fmt: str, multi_line: bool, work: str | None
) -> DataFrame:
    """Rows of a table as text, with their places."""
    if fmt == "csv":
        return _read_csv(spark, path, multi_line, work)
    raw = spark.read.format(fmt).load(path if isinstance(path, str) else list(path))
    places = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
              F.col("_metadata.row_index") if fmt == "parquet" else F.monotonically_increasing_id()]
    return raw.select(
        *[F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns],
        *[place.alias(name) for name, place in zip(PLACE, places, strict=True)],
    )


def plain_path(spark: SparkSession, uri: str) -> str:
    """The path that a scan gives as an encoded address."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def _files(spark: SparkSession, path: str | Sequence[str], fmt: str) -> list[str]:
    """The files of a path in order, as a scan lists them."""
    listed = spark.read.format("text" if fmt == "csv" else fmt).load(path).inputFiles()
    return sorted(plain_path(spark, uri) for uri in listed)


def _sample(
    spark: SparkSession, paths: Sequence[str], active_only: bool, n: int, fmt: str,
    multi_line: bool, work: str,
) -> DataFrame:
    """The first ``n`` wanted rows, by path as given, file, and place in the file.

    Files are read in order, a few and then more, until they hold enough rows.
    """
    files = [(k, f) for k, path in enumerate(paths) for f in _files(spark, path, fmt)]
    tables, rows, at, step = [], 0, 0, FIRST_FILES
    while at < len(files) and rows < n:
        for k in sorted({k for k, _ in files[at : at + step]}):
            part = [f for j, f in files[at : at + step] if j == k]
            raw = _read(spark, part, fmt, multi_line, f"{work}/{len(tables)}")
            raw = raw.withColumn(PLACE[0], F.concat(F.lit(f"{k:06d} "), PLACE[0]))
            tables.append(postings.keep_wanted(raw))
            wanted = postings.prepare_postings(raw.select("expired"), True) if (
                active_only and "expired" in raw.columns
            ) else raw
            rows += wanted.count()
        at, step = at + step, step * MORE_FILES
    if not tables:
        return empty_postings(spark)
    union = postings.union_sources(tables)
    keyed = postings.with_row_key(union)
    return postings.prepare_postings(keyed, active_only, n)


def scan_postings(
    spark: SparkSession,
    path: str | Sequence[str | Sequence[str]],
    active_only: bool = False,
    sample_size: int | None = None,
    fmt: str = "csv",
    multi_line: bool = True,
    work: str | None = None,
) -> DataFrame:
    """Typed postings of one path or of several with differing headers; a list counts as one path.

    Every row gets its key here.  A sample is the first rows by path, file and
    place in the file.  CSV records are stored in the folder ``work`` first, or in
    one of its own in the work folder; without ``multi_line`` each line is one.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if not paths:
        return empty_postings(spark)
    work = work or work_path(spark, f"records-{uuid.uuid4().hex}")
    if sample_size is not None:
        return fill_cores(_sample(spark, paths, active_only, sample_size, fmt, multi_line, work))
    raw = [
        postings.keep_wanted(_read(spark, p, fmt, multi_line, f"{work}/{k}"))
        for k, p in enumerate(paths)
    ]
    keyed = postings.with_row_key(postings.union_sources(raw).drop(*PLACE))
    return postings.prepare_postings(fill_cores(keyed), active_only)


def posting_schema(columns: Sequence[str] = fixed.POSTING_COLUMNS) -> T.StructType:
    """Columns of raw postings, all text."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def empty_postings(spark: SparkSession) -> DataFrame:
    """No rows, all wanted columns, typed."""
    return postings.type_postings(spark.createDataFrame([], posting_schema()))


def scan_taxonomy(
    spark: SparkSession,
    path: str,
    threshold: float = fixed.TAXONOMY_THRESHOLD,
    fmt: str = "csv",
    multi_line: bool = True,
    work: str | None = None,
) -> DataFrame:
    """Cleaned taxonomy; all six source columns are required."""
    return taxonomy.clean_taxonomy(raw_taxonomy(spark, path, fmt, multi_line, work), threshold)


def raw_taxonomy(
    spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = True,
    work: str | None = None,
) -> DataFrame:
    """Taxonomy rows as read, with snake-case names and a numeric correlation."""
    df = taxonomy.rename_taxonomy(_read(spark, path, fmt, multi_line, work).drop(*PLACE))
    df = df.withColumns({c: F.expr(null_tokens(c)) for c in df.columns})
    return df.withColumn("correlation", F.expr(to_number("correlation")))


def _input_status(spark: SparkSession, name: str, path: str) -> DataFrame:
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(1).select(
            F.lit(name).alias("input"),
            F.lit("MISSING").alias("status"),
            F.lit(None).cast("double").alias("size_mb"),
            F.lit(f"{name} not found at {path}").alias("error"),
        )
    # only the length is selected, so no file is opened
    return files.agg(F.bround(F.sum("length") / 1048576, 2).alias("size_mb")).select(
        F.lit(name).alias("input"),
        F.lit("OK").alias("status"),
        "size_mb",
        F.lit(None).cast("string").alias("error"),
    )


def validate_inputs(
    spark: SparkSession, jobs_path: str | Sequence[str], taxonomy_path: str
) -> DataFrame:
    """One row per input: OK with its size in MB, or MISSING with a message.

    Of several job paths the first is called ``jobs``, the others ``jobs 2`` and so on.
    """
    paths = [jobs_path] if isinstance(jobs_path, str) else list(jobs_path)
    named = [("jobs" if k == 1 else f"jobs {k}", p) for k, p in enumerate(paths, 1)]
    status = [_input_status(spark, n, p) for n, p in [*named, ("taxonomy", taxonomy_path)]]
    return reduce(DataFrame.unionByName, status)
