"""Posting rows: typing, cleaning, field extraction, salary merge."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postwright import fixed
from postwright.functions import coerce, fields, text
from postwright.operators.shaping import PLACE, first_in_order

log = logging.getLogger(__name__)

ROW_KEY = "posting_key"
EXTRACTED = [
    "salary_text_min", "salary_text_max", "salary_text_unit", "education_min",
    "experience_min_years", "experience_max_years", *fixed.FLAGS,
]


def keep_wanted(df: DataFrame) -> DataFrame:
    """Wanted columns that the source has, in the wanted order; the rest is pruned.

    A row key and a place given by the source stay.
    """
    missing = set(fixed.POSTING_COLUMNS) - set(df.columns)
    if missing:
        log.warning("columns not in the source: %s", sorted(missing))
    known = (*fixed.POSTING_COLUMNS, ROW_KEY, *PLACE)
    return df.select(*[c for c in known if c in df.columns])


def with_row_key(df: DataFrame) -> DataFrame:
    """Give every posting row a key, unless it has one.

    The key follows partition and row order, so it is best given on a scan,
    where a repeated task yields the same rows in the same order.
    """
    if ROW_KEY in df.columns:
        return df
    return df.withColumn(ROW_KEY, F.monotonically_increasing_id())


def null_missing(df: DataFrame) -> DataFrame:
    """Missing-value texts of every text column become null."""
    texts = [c for c, kind in df.dtypes if kind == "string" and c not in PLACE]
    return df.withColumns({c: F.expr(coerce.null_tokens(c)) for c in texts})


def drop_expired(df: DataFrame) -> DataFrame:
    """Drop rows whose raw ``expired`` text is TRUE; null and padded texts stay."""
    if "expired" not in df.columns:
        return df
    return df.filter(~F.upper("expired").eqNullSafe("TRUE"))


def type_postings(df: DataFrame) -> DataFrame:
    """Text columns to their types; what does not parse is null."""
    # stripped in a step of its own, because the conversion looks at the text many times
    stripped = [c for c in (*fixed.TIMESTAMP_COLUMNS, "system_job_id") if c in df.columns]
    df = df.withColumns({c: F.expr(coerce.strip(c)) for c in stripped})
    typed = {}
    for names, convert in (
        (fixed.BOOLEAN_COLUMNS, coerce.tri_state),
        (fixed.NUMERIC_COLUMNS, coerce.to_number),
        (fixed.TIMESTAMP_COLUMNS, coerce.to_utc_timestamp),
    ):
        typed.update({c: F.expr(convert(c)) for c in names if c in df.columns})
    return df.withColumns(typed)


def prepare_postings(
    raw: DataFrame, active_only: bool = False, sample_size: int | None = None
) -> DataFrame:
    """Raw text columns to typed postings: prune, null, filter, limit, type.

    A sample is the first rows by place where the rows have one, and else the
    first that come.
    """
    df = null_missing(keep_wanted(raw))
    if active_only:
        df = drop_expired(df)
    if sample_size is not None:
        placed = all(c in df.columns for c in PLACE)
        df = first_in_order(df, sample_size) if placed else df.limit(sample_size)
    return type_postings(df.drop(*PLACE))


def union_sources(sources: list[DataFrame]) -> DataFrame:
    """All rows of several posting tables; a column missing in one is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def clean_postings(
    df: DataFrame, column: str = "description", max_length: int | None = None
) -> DataFrame:
    """Add ``description_clean``; empty where the source has no such column."""
    if column not in df.columns:
        log.warning("column %s not found, nothing to clean", column)
        return df.withColumn("description_clean", F.lit(""))
    return text.clean_description(df, column, "description_clean", max_length)


def extract_fields(df: DataFrame, column: str = "description_clean") -> DataFrame:
    """Append the seventeen extracted fields; unchanged where the column is missing."""
    if column not in df.columns:
        log.warning("column %s not found, no fields extracted", column)
        return df
    found = fields.with_wording(
        fields.with_experience(fields.with_salary(df, column), column), column
    )
    return found.select(*df.columns, *EXTRACTED)


def merge_salary(df: DataFrame) -> DataFrame:
    """Final salary: structured columns first, extracted ones second, each on its own."""

    def first_of(*columns: str) -> Column:
        present = [F.col(c) for c in columns if c in df.columns]
        return F.coalesce(*present) if present else F.lit(None).cast("double")

    units = []
    if "parameters_salary_unit" in df.columns:
        units.append(F.expr("CASE WHEN parameters_salary_unit <> '' THEN parameters_salary_unit END"))
    if "salary_text_unit" in df.columns:
        units.append(F.col("salary_text_unit"))
    units.append(F.expr("CASE WHEN salary_final_min IS NOT NULL THEN 'annual' END"))
    return df.withColumns(
        {
            "salary_final_min": first_of("parameters_salary_min", "salary_text_min"),
            "salary_final_max": first_of("parameters_salary_max", "salary_text_max"),
        }
    ).withColumn("salary_final_unit", F.coalesce(*units))


def structure_fields(df: DataFrame, max_length: int | None = None) -> DataFrame:
    """Typed postings to cleaned text, extracted fields and merged salary; no shuffle."""
    return merge_salary(extract_fields(clean_postings(df, max_length=max_length)))
