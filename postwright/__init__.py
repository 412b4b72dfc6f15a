"""Turn free-text job postings into tables with Spark."""

from postwright.operators.mapping import map_to_taxonomy
from postwright.operators.postings import (
    clean_postings,
    drop_expired,
    extract_fields,
    merge_salary,
    prepare_postings,
    union_sources,
)
from postwright.operators.report import coverage, description_stats, quality_report, top_skills
from postwright.operators.similarity import build_index, similar_skills, similarity_matches
from postwright.operators.skills import (
    attach_skill_count,
    attach_summary,
    attach_top_skills,
    build_lookup,
    map_postings,
)
from postwright.operators.taxonomy import clean_taxonomy, exact_lookup, taxonomy_stats
from postwright.plans.structure import Rules, run, structure
from postwright.session import session
from postwright.sinks.runs import published
from postwright.sinks.tables import write_report, write_table
from postwright.sources.tables import scan_postings, scan_taxonomy, validate_inputs
from postwright.streaming.incremental import (
    merged,
    running_report,
    running_totals,
    stream_files,
    stream_postings,
    structure_stream,
)

__all__ = [
    "Rules", "attach_skill_count", "attach_summary", "attach_top_skills", "build_index", "build_lookup",
    "clean_postings", "clean_taxonomy", "coverage", "description_stats", "drop_expired",
    "exact_lookup", "extract_fields", "map_postings", "map_to_taxonomy", "merge_salary", "merged",
    "prepare_postings", "published", "quality_report", "run", "running_report", "running_totals",
    "scan_postings", "scan_taxonomy", "session", "similar_skills", "similarity_matches",
    "stream_files", "stream_postings", "structure", "structure_stream", "taxonomy_stats", "top_skills", "union_sources",
    "validate_inputs", "write_report", "write_table",
]
