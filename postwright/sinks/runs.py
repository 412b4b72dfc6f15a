"""Outputs of a run that appear together or not at all.

Each run writes to a folder of its own.  Its manifest, which names the tables, is written last;
readers follow the newest manifest.  So a run that breaks off leaves the earlier one whole, and a
reader never meets tables of two runs.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from postwright.session import discard, exists, finished, folders

RUNS, MANIFESTS = "runs", "published"


def _number(folder: str) -> int:
    return int(folder.rsplit("=", 1)[1])


def start(spark: SparkSession, out: str) -> tuple[int, str]:
    """Number and folder of a new run; numbers of broken runs are not used again."""
    known = [*folders(spark, f"{out}/{RUNS}"), *folders(spark, f"{out}/{MANIFESTS}")]
    number = 1 + max((_number(f) for f in known), default=0)
    return number, f"{out}/{RUNS}/run={number}"


def publish(spark: SparkSession, out: str, number: int, tables: Sequence[str]) -> None:
    """Make the tables of a run the current ones; all of them must have been written."""
    place = f"{out}/{RUNS}/run={number}"
    missing = [t for t in tables if not exists(spark, f"{place}/{t}/_SUCCESS")]
    if missing:
        raise ValueError(f"run {number} has not written {', '.join(missing)}")
    # relative, so that the whole output may be moved
    named = {t: f"{RUNS}/run={number}/{t}" for t in tables}
    manifest = spark.createDataFrame([(json.dumps(named),)], "value string").coalesce(1)
    manifest.write.text(f"{out}/{MANIFESTS}/run={number}")


def published(spark: SparkSession, out: str) -> dict[str, str]:
    """Paths of the current tables by name; none before the first run has ended."""
    ended = finished(spark, f"{out}/{MANIFESTS}")
    if not ended:
        return {}
    named = json.loads(spark.read.text(max(ended, key=_number)).first()[0])
    return {table: f"{out}/{path}" for table, path in named.items()}


def retire(spark: SparkSession, out: str, keep: int = 2) -> list[str]:
    """Remove all but the last published runs, and broken ones older than these."""
    ended = sorted(_number(f) for f in finished(spark, f"{out}/{MANIFESTS}"))
    if len(ended) < keep:
        return []
    oldest = ended[-keep]
    gone = [
        f for part in (MANIFESTS, RUNS) for f in folders(spark, f"{out}/{part}")
        if _number(f) < oldest
    ]
    for folder in gone:
        discard(spark, folder)
    return gone
