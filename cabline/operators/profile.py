"""Profiling aggregates over the wide table and the sample (one pass each)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabline.operators.selection import exact_percentiles


def service_summary(wide: DataFrame) -> DataFrame:
    """Rows and year/month ranges per service, ordered by service."""
    return (wide.groupBy("service_type")
            .agg(F.count(F.lit(1)).alias("filas"),
                 F.min("year").alias("min_year"), F.max("year").alias("max_year"),
                 F.min("month").alias("min_month"), F.max("month").alias("max_month"))
            .orderBy("service_type"))


def year_service_counts(wide: DataFrame) -> DataFrame:
    """Rows per (year, service), ordered."""
    return (wide.groupBy("year", "service_type").agg(F.count(F.lit(1)).alias("filas"))
            .orderBy("year", "service_type"))


def service_year_ranges(wide: DataFrame) -> DataFrame:
    """Trips, first and last pickup per (service, year)."""
    return (wide.groupBy("service_type", "year")
            .agg(F.count(F.lit(1)).alias("trips"),
                 F.min("pickup_datetime").alias("first_pickup"),
                 F.max("pickup_datetime").alias("last_pickup"))
            .orderBy("service_type", "year"))


def rows_per(df: DataFrame, keys: Iterable[str], name: str = "rows") -> DataFrame:
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(*keys)


# ------------------------------------------------------------------ EDA on a frame



def attach(df: DataFrame, small: DataFrame) -> DataFrame:
    """Append the columns of a one-row frame to every row (one broadcast row)."""
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(small.withColumn("_one", F.lit(1))), "_one").drop("_one"))


def describe(df: DataFrame, col: str, digits: int = 6) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max of one column (one row)."""
    base = df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"),
                  F.stddev_samp(col).alias("std"), F.min(col).alias("min"), F.max(col).alias("max"))
    q = exact_percentiles(df, col, [0.25, 0.5, 0.75])
    out = attach(base, q.select(F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"),
                                F.col("q")[2].alias("p75")))
    return out.select("count", *[F.round(c, digits).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL count per column, only those with NULLs, most first (one pass + unpivot)."""
    columns = columns or df.columns
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns])
    long = wide.unpivot([], columns, "column_name", "nulls")
    return long.where(F.col("nulls") > 0).orderBy(F.desc("nulls"), "column_name")


def cardinality(df: DataFrame, columns: list[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct non-NULL values per column; ``approx`` uses HyperLogLog++ sketches
    (fixed memory per column instead of exact distinct sets)."""
    if approx:
        wide = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns])
        return wide.unpivot([], columns, "column_name", "n_unique").orderBy("column_name")
    # one narrow aggregate a column: several distinct counts in one would copy every row
    # once a column before its shuffle
    out = None
    for c in columns:
        one = df.select(c).where(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1)).alias("n_unique"))
        one = one.select(F.lit(c).alias("column_name"), "n_unique")
        out = one if out is None else out.unionByName(one)
    return out.orderBy("column_name")


def not_a_number(df: DataFrame, columns: list[str]) -> DataFrame:
    """NaN count per numeric column."""
    wide = df.agg(*[F.count_if(F.isnan(F.col(c).cast("double"))).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "nans").orderBy("column_name")


def top_values(df: DataFrame, col: str, k: int = 20, name: str = "n") -> DataFrame:
    """k most frequent non-NULL values; ties broken by the value itself."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.desc(name), F.asc(col)).limit(k))


def histogram(df: DataFrame, expr, bins: int = 50, digits: int = 6) -> DataFrame:
    """Equal-width histogram between min and max (the maximum falls in the last bin);
    every bin is listed, empty ones with 0. NULL and NaN are in no bin and do not move the
    edges; ``not_a_number`` counts the latter."""
    x = df.select(expr.cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    rng = x.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    width = F.nullif((F.col("_hi") - F.col("_lo")) / F.lit(float(bins)), F.lit(0.0))
    binned = attach(x, rng).withColumn(
        "bin", F.coalesce(F.least(F.floor((F.col("_x") - F.col("_lo")) / width).cast("int") + 1, F.lit(bins)),
                          F.lit(1)))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    grid = attach(spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin")), rng)
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return (grid.join(counts, "bin", "left")
            .select("bin",
                    F.round(F.col("_lo") + (F.col("bin") - 1) * w, digits).alias("lo"),
                    F.round(F.col("_lo") + F.col("bin") * w, digits).alias("hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast(T.LongType()).alias("count"))
            .orderBy("bin"))
