"""The operators of this folder as queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postwright.llm import (
    collocations, decontaminate, html_wrapper, langid, licenses, line_rules, minhash, mixing,
    secrets, spelling, substrings, toxicity, warc,
)
from postwright.llm.common import table


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op2_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_wrapper.extract(table(spark, folder, "pages"))


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.components_of(table(spark, folder, "documents")).drop("component", "_row")


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    ).drop("evidence")


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.scan(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    ).drop("spans")


def op6_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


def op8_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.measure(table(spark, folder, "documents"))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "source", "mix_tokens", "mix_weight", "mix_epoch", "mix_order"
    )


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group(table(spark, folder, "documents"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(table(spark, folder, "documents"))


def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.measure(table(spark, folder, "documents")).drop("removed")


ALL = [
    op1_license_scan, op2_html_extract, op3_near_duplicates, op4_toxicity, op5_decontaminate, op6_warc_revisits,
    op7_secret_scan, op8_line_rules, op9_language, op10_mixing, op11_spelling_variants,
    op12_collocations, op13_substring_dedup,
]
LLM_QUERIES = {query.__name__: query for query in ALL}
