"""Exact ranks without one task per group.

A window ``PARTITION BY stratum ORDER BY ts`` puts a whole stratum into one task, and a
global ``ORDER BY`` without partitioning puts everything into one. Here rows are dealt out
by *range* of (group, full order key), with a row id last, so that a stratum or a tied
value of any size spreads over as many partitions as it needs. The result is stored once
with its partition number; a small count per (partition, group) gives every partition's
offset in its group; row numbers are computed inside partitions only.

The counts have at most ``partitions + groups`` rows and stay DataFrames; nothing is
collected. Groups join null-safely, so a NULL stratum is a group like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabline.session import materialize


def same_groups(left: DataFrame, right: DataFrame, by: Sequence[str], *more: Column) -> Column:
    """Null-safe equality on the group columns (renamed ``_r_*`` on the right)."""
    conds = [left[c].eqNullSafe(right[f"_r_{c}"]) for c in by] + list(more)
    return reduce(lambda a, b: a & b, conds)


def _renamed(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"_r_{c}" for c in by})


def _ranged(df: DataFrame, by: Sequence[str], order: Sequence[Column], partitions: int | None) -> DataFrame:
    """Rows with ``_id`` and ``_p``: contiguous ranges of (group, order, id), stored once."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.asc_nulls_first(c) for c in by] + list(order) + [F.asc("_id")]
    dealt = df.withColumn("_id", F.monotonically_increasing_id()).repartitionByRange(n, *keys)
    return materialize(dealt.withColumn("_p", F.spark_partition_id()), "ranged")


def _offsets(ranged: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per (group, partition): rows ``_cnt``, rows before ``_off`` and group size ``_n``."""
    counts = ranged.groupBy(*by, "_p").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return (counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
            .withColumn("_n", F.sum("_cnt").over(Window.partitionBy(*by))))


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """Add ``_rn`` (1-based row number in ``order`` within each ``by`` group, NULL groups
    included) and ``_n`` (group size). End ``order`` in a unique tie-break for numbers that
    do not depend on the input's layout."""
    by = list(by)
    ranged = _ranged(df, by, order, partitions)
    off = _renamed(_offsets(ranged, by), by).withColumnRenamed("_p", "_rp")
    local = F.row_number().over(Window.partitionBy("_p", *by).orderBy(*order, F.asc("_id")))
    numbered = ranged.withColumn("_local", local)
    return (numbered.join(off, same_groups(numbered, off, by, numbered["_p"] == off["_rp"]))
            .withColumn("_rn", F.col("_off") + F.col("_local"))
            .select(*df.columns, "_rn", "_n"))


def global_row_number(df: DataFrame, order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (ORDER BY ...)`` over the whole frame, without one task."""
    return rank_within(df, [], order, partitions)
