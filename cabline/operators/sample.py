"""Quality filter and stratified systematic time sample."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabline import schemas
from cabline.operators.ranking import rank_within

# Plausibility bounds of the modelling sample.
DISTANCE_OPEN = (0, 100)
PASSENGERS = (1, 6)
TOTAL = (2, 250)


def quality_filter(wide: DataFrame, years: Iterable[int] | None = None) -> DataFrame:
    """Rows fit for modelling; each predicate is a plain comparison, pushed to the scan."""
    c = F.col
    cond = (c("pickup_datetime").isNotNull()
            & (c("trip_distance") > DISTANCE_OPEN[0]) & (c("trip_distance") < DISTANCE_OPEN[1])
            & c("passenger_count").between(*PASSENGERS)
            & c("total_amount").between(*TOTAL)
            & (c("fare_amount") > 0))
    if years is not None:
        cond = c("year").isin([int(y) for y in years]) & cond
    return wide.where(cond)


def basic_quality_filter(wide: DataFrame) -> DataFrame:
    """The documented lighter rule set: positive total and positive distance."""
    return wide.where((F.col("total_amount") > 0) & (F.col("trip_distance") > 0))


def buckets_per_month(rows_per_year: int) -> Column:
    """Bucket count of a month: the year's quota spread over 12 months, the remainder
    going one each to the first months."""
    q, r = divmod(int(rows_per_year), 12)
    return F.when(F.col("month") <= r, F.lit(q + 1)).otherwise(F.lit(q))


def first_of_ntile(rn: Column, n: Column, k: Column) -> Column:
    """True when row ``rn`` (1-based) of ``n`` opens one of ``k`` NTILE buckets.

    NTILE gives the first ``n mod k`` buckets ``n div k + 1`` rows and the rest
    ``n div k``; this closed form needs no second window and accepts a per-row ``k``.
    """
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    return (k > 0) & F.when(rn <= big, F.pmod(rn - 1, q + 1) == 0).otherwise(
        F.pmod(rn - big - 1, F.greatest(q, F.lit(1))) == 0)


def ntile_of(rn: Column, n: Column, k: Column) -> Column:
    """NTILE bucket (1-based) of row ``rn`` of ``n`` with a per-row bucket count ``k``."""
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    return F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1).otherwise(
        r + F.floor((rn - big - 1) / F.greatest(q, F.lit(1))) + 1).cast("int")


def sample_order(columns: Sequence[str] = schemas.SAMPLE_COLUMNS, time_col: str = "pickup_datetime") -> list[Column]:
    """Time first, then every other output column: ties resolve the same way each run."""
    return [F.asc_nulls_first(time_col)] + [F.asc_nulls_first(c) for c in columns if c != time_col]


def stratified_time_sample(df: DataFrame, rows_per_year: int, strata: Sequence[str] = ("year", "month"),
                           time_col: str = "pickup_datetime",
                           columns: Sequence[str] = schemas.SAMPLE_COLUMNS) -> DataFrame:
    """First row of each of k(month) equal-count time buckets per stratum (systematic
    sample spread evenly over time), in time order. Ranks come from ``rank_within``, so a stratum is
    never one task."""
    base = df.select(*columns)
    ranked = rank_within(base, list(strata), sample_order(columns, time_col))
    k = buckets_per_month(rows_per_year)
    keep = first_of_ntile(F.col("_rn"), F.col("_n"), k)
    return ranked.where(keep).select(*columns).orderBy(*sample_order(columns, time_col))
