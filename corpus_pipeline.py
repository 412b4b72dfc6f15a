"""Documents to a training mixture in five stages.

Each stage takes (spark, documents, folder of tables), works on all that the
stage before it kept, and returns a table; ``run`` writes each result to the
shared work folder and reads it back for the next one.  All stages but the last
return the columns of the documents.  What each does with nulls, ties, repeated
rows and empty tables is said by its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postwright.llm import decontaminate, line_rules, minhash, mixing, secrets
from postwright.llm.common import stage, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines frequent on their host."""
    return line_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a test item occurs."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often and in the order the target weights ask for."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("mixing sources", source_mixing),
]

#: Similarity, secret structures and the automaton's spans are beyond SQL; the tests
#: hold the pipeline against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
