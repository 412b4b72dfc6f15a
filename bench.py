"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of cores.  Query
names given as arguments replace the default list.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from workload.queries import QUERIES

HEADLINE = [
    "scan_postings", "clean_text", "clean_documents", "description_stats", "mask_pii",
    "extract_salary", "extract_education", "extract_experience", "benefit_flags",
    "merge_salary", "taxonomy_lookup", "skill_ngrams", "skill_vocab_scan",
    "structured_skills", "structured_jobs", "tfidf_index", "skill_tfidf_match",
    "map_to_taxonomy", "coverage", "top_skills", "quality_report", "full_run",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="postwright-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start-up of the session is not a query's cost
    spark.read.parquet(f"{folder}/region.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        # every query is timed on its own, without tables cached by the one before
        spark.catalog.clearCache()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
