"""Grouping and joining helpers that hold up under skew."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# A reference table is broadcast only when its measured size is below this.
BROADCAST_BYTES = 64 << 20
# Where a row of a file comes from: file, start of the split in it, number in the split.
PLACE = ("_file", "_block", "_seq")
# Rows that one task takes at most where the work on a row is heavy.
ROWS_PER_TASK = 25_000
# A key counts as hot from this share of all rows on.
HOT_SHARE = 0.005


def tasks_for(rows: int, cores: int, per_task: int = ROWS_PER_TASK) -> int:
    """Tasks for so many rows: one per core at least, and none with more rows than it may take."""
    return max(cores, -(-rows // per_task))


def fill_cores(scan: DataFrame, *by: Column) -> DataFrame:
    """Spread a scan that has fewer partitions than its rows, or the cores, need.

    Text work costs far more than moving an input: few bytes of a file can hold many
    rows, and some files cannot be split.  The rows are counted, for Parquet from the
    footers.  With ``by``, rows of equal values meet in a partition of that many.
    """
    wanted = tasks_for(scan.count(), scan.sparkSession.sparkContext.defaultParallelism)
    if by:
        return scan.repartition(wanted, *by)
    return scan.repartition(wanted) if scan.rdd.getNumPartitions() < wanted else scan


def spread_rows(df: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Deal the rows to tasks by their number, whatever partitions the source gives.

    For sources whose partitions are not known, such as a batch of a stream: one file that
    cannot be split, or a join with a small table, would leave all rows to one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks_for(df.count(), cores, per_task))


def first_per(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1
) -> DataFrame:
    """First ``n`` rows per key group in the given order.

    The rank filter is planned with a group limit before the exchange, so a hot
    group ships at most ``n`` rows per task, not all of its rows.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )


def first_in_order(rows: DataFrame, n: int, place: Sequence[str] = PLACE) -> DataFrame:
    """The first ``n`` rows by file, split and number, spread over the tasks that hold them.

    Rows are counted per split; the splits before the cut are taken whole, and
    only in the one that holds the cut are rows numbered.
    """
    file, block, seq = place
    counts = rows.groupBy(file, block).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy(file, block))  # one row per split
    cut = (
        counts.withColumn("_upto", upto)
        .withColumn("_before", F.col("_upto") - F.col("_n"))
        .filter(F.col("_before") < n)
        .select(file, block, "_upto", "_before")
    )
    taken = rows.join(cut, [file, block])
    whole = taken.filter(F.col("_upto") <= n)
    order = Window.partitionBy(file, block).orderBy(seq)
    part = taken.filter(F.col("_upto") > n).withColumn("_at", F.row_number().over(order))
    part = part.filter(F.col("_at") <= n - F.col("_before")).drop("_at")
    return whole.unionByName(part).select(rows.columns)


@dataclass(frozen=True)
class Reference:
    """A small-side table together with its measured size."""

    table: DataFrame
    rows: int
    bytes: int
    facts: dict = field(default_factory=dict)

    def only(self, *columns: str | Column) -> Reference:
        """The same reference with fewer columns; the measured size stays an upper bound."""
        return replace(self, table=self.table.select(*columns))

    def release(self) -> None:
        """Drop the cached rows; the table stays usable."""
        self.table.unpersist()

    def fits(self, limit: int | None = None) -> bool:
        return self.bytes <= (BROADCAST_BYTES if limit is None else limit)


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(0).cast("long")
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            width = F.coalesce(F.octet_length(column), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)) + 32
        else:
            width = F.lit(8)
        size = size + width
    return size


def measured(df: DataFrame, persist: bool = True, **facts: Column) -> Reference:
    """Cache a reference table and measure it, and any further facts, with one aggregate.

    The cache is only a saving: a lost block is recomputed from the lineage.  A
    table that is read from a file of its own needs none.
    """
    df = df.persist() if persist else df
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes"),
        *[column.alias(name) for name, column in facts.items()],
    ).first()
    return Reference(df, row["rows"], row["bytes"], {name: row[name] for name in facts})


def _scatter(salts: int, columns: Sequence[str]) -> Column:
    """Salt of a row.  The partition number tells full copies of a row apart."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), F.lit(salts)).cast("int")


def _spread(df: DataFrame) -> int:
    """Salt values for a skewed shuffle: a fraction of the shuffle width, within bounds."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(8, min(256, width // 4))


def probe(
    stream: DataFrame,
    reference: Reference,
    on: str,
    spread_by: Sequence[str],
    how: str = "inner",
    limit: int | None = None,
) -> DataFrame:
    """Join a large table to a reference table with its size checked.

    Within the limit the reference is broadcast and the large side does not
    move.  Beyond it both sides are shuffled on the key; only hot keys of the
    large side, found by a sketch, are salted, and only their reference rows are
    repeated.
    """
    if reference.fits(limit):
        return stream.join(F.broadcast(reference.table), on, how)
    return join_spread(stream, reference.table, on, spread_by, how)


@dataclass(frozen=True)
class Skew:
    """What is known about the keys of a large table: the hot ones, and if nulls are many."""

    keys: list[str]
    nulls: bool = False


def find_skew(df: DataFrame, key: str, share: float = HOT_SHARE, k: int = 200) -> Skew:
    """Keys that hold at least ``share`` of the rows, from one frequent-items sketch.

    The sketch is merged map-side and has a fixed size; at most ``k`` keys come
    back.  It steers the physical layout only; no row depends on it.
    """
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(key).isNull()).alias("nulls"),
        F.expr(f"approx_top_k({key}, {k}, 4096)").alias("top"),
    ).first()
    least = max(2.0, share * row["rows"])
    hot = [i["item"] for i in row["top"] or [] if i["item"] is not None and i["count"] >= least]
    return Skew(hot, row["nulls"] >= least)


def join_spread(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "left",
    skew: Skew | None = None,
) -> DataFrame:
    """Equi-join of two large tables where a few keys may fill much of the left side.

    Only the hot keys are salted: their left rows scatter over the salts and
    their right rows are repeated, while all other keys join as usual.  Left
    rows with a null key match nothing; where they are many they scatter too.
    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.
    """
    skew = find_skew(left, key) if skew is None else skew
    if not skew.keys and not skew.nulls:
        return left.join(right, key, how)
    salts = _spread(left)
    is_hot = F.col(key).isin(skew.keys) if skew.keys else F.lit(False)
    salt = F.when(F.col(key).isNull() | is_hot, _scatter(salts, spread_by)).otherwise(F.lit(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.withColumn("_salt", F.explode(copies))
    return left.withColumn("_salt", salt).join(repeated, [key, "_salt"], how).drop("_salt")
