"""Output projection, formatting and writing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwright import fixed
from postwright.functions.coerce import yes_no

CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd HH:mm:ssxxx",
    "timeZone": "UTC",
}


def job_columns(jobs: DataFrame, include_description: bool = False) -> DataFrame:
    """Output columns in order, as far as the table has them."""
    wanted = list(fixed.JOB_OUTPUT_COLUMNS)
    if include_description:
        wanted.append("description_clean")
    return jobs.select(*[c for c in wanted if c in jobs.columns])


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating-point column, halves to even."""
    return df.withColumns(
        {c: F.bround(c, digits) for c, kind in df.dtypes if kind in ("double", "float")}
    )


def render_booleans(df: DataFrame) -> DataFrame:
    """Every boolean column as Yes, No or null."""
    return df.withColumns({c: F.expr(yes_no(c)) for c, kind in df.dtypes if kind == "boolean"})


def format_jobs(jobs: DataFrame, include_description: bool = False) -> DataFrame:
    """The job table as it is written."""
    return render_booleans(round_doubles(job_columns(jobs, include_description)))


def format_skills(skills: DataFrame) -> DataFrame:
    """The skills table as it is written; a missing job id is spelled ``nan``."""
    columns = [c for c in fixed.SKILL_OUTPUT_COLUMNS if c in skills.columns]
    named = skills.select(*columns).fillna("nan", subset=["system_job_id"])
    return round_doubles(named)


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Replace the table at ``path``, or add to it; CSV always carries a header."""
    options = CSV_OPTIONS if fmt == "csv" else {}
    df.write.mode(mode).format(fmt).options(**options).save(path)


def write_report(report: DataFrame, path: str) -> None:
    """The one-row report as indented JSON."""
    text = report.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value"))
    text.coalesce(1).write.mode("overwrite").text(path)
