"""Taxonomy preparation and the exact lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwright import fixed
from postwright.functions.coerce import strip
from postwright.operators.shaping import first_per


def rename_taxonomy(df: DataFrame) -> DataFrame:
    """The six source headings in snake case; all six must be there."""
    return df.select(
        *[F.col(f"`{source}`").alias(name) for source, name in fixed.TAXONOMY_COLUMNS.items()]
    )


def _best_first(df: DataFrame, keys: list[str]) -> list:
    """Highest correlation first; ties by the remaining columns, nulls last."""
    rest = [c for c in df.columns if c not in keys and c != "correlation"]
    return [F.col("correlation").desc()] + [F.col(c).asc_nulls_last() for c in rest]


def clean_taxonomy(df: DataFrame, threshold: float = fixed.TAXONOMY_THRESHOLD) -> DataFrame:
    """Threshold, normalise the texts, keep the best row per (research_id, raw_skill)."""
    kept = df.filter(F.col("correlation") >= threshold).withColumns(
        {c: F.expr(f"lower({strip(c)})") for c in fixed.TAXONOMY_TEXT_COLUMNS}
    )
    keys = ["research_id", "raw_skill"]
    return first_per(kept, keys, _best_first(kept, keys))


def exact_lookup(taxonomy: DataFrame) -> DataFrame:
    """Best row per raw skill; a missing raw skill cannot be looked up."""
    named = taxonomy.filter(F.col("raw_skill").isNotNull())
    return first_per(named, ["raw_skill"], _best_first(named, ["raw_skill"]))


def best_per_skill(taxonomy: DataFrame) -> DataFrame:
    """Best row per taxonomy skill."""
    return first_per(taxonomy, ["taxonomy_skill"], _best_first(taxonomy, ["taxonomy_skill"]))


def unknown_sources(taxonomy: DataFrame) -> DataFrame:
    """Source names outside the known ones, null included."""
    known = F.coalesce(F.col("taxonomy_source").isin(fixed.KNOWN_SOURCES), F.lit(False))
    return taxonomy.select("taxonomy_source").filter(~known).distinct()


def taxonomy_stats(raw: DataFrame, threshold: float = fixed.TAXONOMY_THRESHOLD) -> DataFrame:
    """Row counts before and after the threshold, and of the cleaned table."""
    cleaned = clean_taxonomy(raw, threshold).agg(
        F.count(F.lit(1)).alias("mappings"),
        F.count_distinct("research_id").alias("distinct_jobs"),
    )
    return raw.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.col("correlation") >= threshold).alias("rows_after"),
    ).select(
        "rows_before",
        "rows_after",
        cleaned.select("mappings").scalar().alias("mappings"),
        cleaned.select("distinct_jobs").scalar().alias("distinct_jobs"),
    )
