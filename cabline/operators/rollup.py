"""Summaries kept per partition and refreshed where the table changed.

A summary table holds one row, a cell, per (partition, year, month) of the wide table: rows,
first and last pickup, and a mergeable distinct-count sketch per column. Summaries of any
coarser grain merge cells, so that after a partition was replaced only that partition is
read again, however large the table is. Counts and ranges equal those of the full scan;
distinct counts are HyperLogLog estimates (exact for a few dozen values).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabline.sources import sinks
from cabline.sources.sinks import WIDE_PARTITIONS

#: Columns whose distinct values are sketched, and the sketches' size (2^12 registers).
SKETCHED = ("vendor_id", "rate_code_id", "payment_type", "pu_location_id", "do_location_id")
LG_K = 12


def cells(wide: DataFrame, keys: Sequence[str] = WIDE_PARTITIONS, columns: Sequence[str] = SKETCHED) -> DataFrame:
    """One row per (partition, year, month)."""
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K)).alias(f"d_{c}") for c in columns]
    return wide.groupBy(*keys, "year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.min("pickup_datetime").alias("first_pickup"), F.max("pickup_datetime").alias("last_pickup"), *sketches)


def refresh(spark: SparkSession, wide_path: str, summary_path: str, touched: Iterable[tuple],
            keys: Sequence[str] = WIDE_PARTITIONS, columns: Sequence[str] = SKETCHED) -> dict:
    """Replace the cells of the ``touched`` partitions; the partition filter prunes the scan
    to them. A partition that is gone loses its cells."""
    touched = [tuple(w) for w in touched]
    if not touched:
        return {"written": 0, "skipped": [], "replaced": [], "new": [], "emptied": []}
    rows = spark.read.parquet(wide_path).where(sinks.any_partition(keys, touched))
    return sinks.partition_replace(spark, cells(rows, keys, columns), summary_path, touched, overwrite=True, keys=keys)


def _distinct(columns: Sequence[str]) -> list[Column]:
    return [F.hll_sketch_estimate(F.hll_union_agg(f"d_{c}")).alias(f"n_{c}") for c in columns]


def service_summary(summary: DataFrame) -> DataFrame:
    """As ``profile.service_summary``, from cells."""
    return (summary.groupBy("service_type").agg(
        F.sum("rows").alias("filas"), F.min("year").alias("min_year"), F.max("year").alias("max_year"),
        F.min("month").alias("min_month"), F.max("month").alias("max_month")).orderBy("service_type"))


def year_service_counts(summary: DataFrame) -> DataFrame:
    """As ``profile.year_service_counts``, from cells."""
    return summary.groupBy("year", "service_type").agg(F.sum("rows").alias("filas")).orderBy("year", "service_type")


def service_year_ranges(summary: DataFrame, distinct: Sequence[str] = ()) -> DataFrame:
    """As ``profile.service_year_ranges``, from cells, with distinct counts of columns."""
    return (summary.groupBy("service_type", "year").agg(
        F.sum("rows").alias("trips"), F.min("first_pickup").alias("first_pickup"), F.max("last_pickup").alias("last_pickup"),
        *_distinct(distinct)).orderBy("service_type", "year"))


def rows_per_month(summary: DataFrame) -> DataFrame:
    return summary.groupBy("year", "month").agg(F.sum("rows").alias("rows")).orderBy("year", "month")


def cardinality(summary: DataFrame, columns: Sequence[str] = SKETCHED) -> DataFrame:
    """Distinct values per column of the whole table, as estimates."""
    wide = summary.agg(*_distinct(columns)).withColumnsRenamed({f"n_{c}": c for c in columns})
    return wide.unpivot([], list(columns), "column_name", "n_unique").orderBy("column_name")
