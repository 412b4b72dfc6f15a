"""Session settings and the shared work folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of code of a method beyond which the JVM never compiles it.
COMPILED_BYTES = "8000"


def session(app: str = "postwright", **settings: str) -> SparkSession:
    """A session with the settings this library is written for."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where that is not set, a folder in the warehouse, which all executors share too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/postwright-work"
    return f"{base.rstrip('/')}/{name}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate tables through the file system that holds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Jobs of the block run their projections in methods that the JVM compiles.

    Spark puts a whole stage into one method, which with many long expressions grows beyond
    what the JVM compiles and is then interpreted for every row.  With this limit such a
    stage is run by its projections, which are split into small methods.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, COMPILED_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table once and go on from the file: what follows no longer depends on the past."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def folders(spark: SparkSession, path: str, marker: str | None = None) -> list[str]:
    """The folders in a folder, or those of them that hold a file of this name; none where it is missing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    found = [f.getPath() for f in system.listStatus(place) if f.isDirectory()]
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(
        f"{path}/{f.getName()}" for f in found if marker is None or system.exists(path_of(f, marker))
    )


def finished(spark: SparkSession, path: str) -> list[str]:
    """The tables in a folder whose writing ended."""
    return folders(spark, path, "_SUCCESS")


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def write_small(spark: SparkSession, folder: str, text: str) -> None:
    """A folder of one small text and, once that is whole, the mark of a finished table; no job."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    place = path_of(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for name, data in (("text", text.encode()), ("_SUCCESS", b"")):
        stream = system.create(path_of(place, name), True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()


def read_small(spark: SparkSession, folder: str) -> str:
    """What ``write_small`` has written."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder, "text")
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
